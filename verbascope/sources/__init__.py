"""Files in, tables out, and back."""
