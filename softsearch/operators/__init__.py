"""Relational and iterative operators over DataFrames."""
