"""Operators: DataFrame in, DataFrame out, driven by column names. None knows the warehouse's tables."""
