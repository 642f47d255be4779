"""Stateless cleaning on streaming DataFrames."""
