"""Cost-data analytics on plain Spark DataFrames.

Every operator is a function from DataFrame (or Column) to DataFrame (or Column); nothing runs
until the caller acts on the result, except where a docstring says so.
"""
