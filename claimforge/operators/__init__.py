"""Operators that Spark has no single word for, as compositions of DataFrame operations."""
