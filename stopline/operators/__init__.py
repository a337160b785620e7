"""Relational building blocks: DataFrames in, DataFrame out, no action run."""
