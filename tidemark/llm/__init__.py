"""Operators of a training-data pipeline, each a function over DataFrames."""
