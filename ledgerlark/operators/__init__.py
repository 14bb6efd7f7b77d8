"""Operators from DataFrame to DataFrame, with columns as parameters."""
