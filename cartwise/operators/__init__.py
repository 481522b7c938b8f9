"""Relational and numeric operators on DataFrames."""
