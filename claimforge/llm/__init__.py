"""Operators for preparing training corpora, each built on Spark DataFrames."""
