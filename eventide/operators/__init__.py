"""Operators: each takes DataFrames and gives a DataFrame, with no work on the driver beyond bounds."""
