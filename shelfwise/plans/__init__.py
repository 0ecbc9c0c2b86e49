"""Composed jobs: DataFrames in, one DataFrame out. Reading and writing stay with the caller."""
