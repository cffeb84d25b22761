"""Column expressions: Column in, Column out. All are Spark built-ins."""
