"""Relational operators: DataFrames in, one DataFrame out, nothing executed."""
