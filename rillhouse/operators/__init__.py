"""Relational operators of the warehouse, DataFrame in, DataFrame out."""
