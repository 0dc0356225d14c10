"""Column-level functions; each takes columns and returns one column."""
