"""Analytic operators: DataFrame in, DataFrame out."""
