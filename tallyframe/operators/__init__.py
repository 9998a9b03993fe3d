"""Operators over DataFrames. Every function takes group keys ``by`` (possibly empty)."""
