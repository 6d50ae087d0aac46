"""Column and schema functions."""
