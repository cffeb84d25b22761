"""The warehouse: dimensions, facts, views, checks and measures, each a function of DataFrames."""
