"""The registered queries: views over the given tables, the Spark queries, and DuckDB SQL to check them."""
