"""Versioned linked-data operators for PySpark: DataFrame in, DataFrame out."""
