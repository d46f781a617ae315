"""Operators: DataFrame -> DataFrame, lazy unless stated."""
