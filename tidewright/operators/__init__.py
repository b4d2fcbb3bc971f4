"""Operators over DataFrames: change, joins, builders, reports and checks."""
