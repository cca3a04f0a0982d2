"""Analytical operators: pure functions (DataFrames, column names, parameters) -> DataFrame."""
