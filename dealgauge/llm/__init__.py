"""Operators that prepare text for language-model training, all as Spark jobs."""
