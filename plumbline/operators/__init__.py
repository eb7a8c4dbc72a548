"""Data-quality operators: DataFrame in, DataFrame out."""
