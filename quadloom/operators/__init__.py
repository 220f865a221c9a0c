"""Operators: DataFrame in, DataFrame out, nothing run until the caller does."""
