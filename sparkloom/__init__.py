"""Reusable PySpark data jobs: DataFrame in, DataFrame out."""
