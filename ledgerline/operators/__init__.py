"""Relational, analytical and quality operators on DataFrames."""
