"""Spark-native analytics engine: claims processing, relational operators and corpus operators."""
