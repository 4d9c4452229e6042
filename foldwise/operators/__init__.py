"""Operators: functions from DataFrames to DataFrames, and fit/transform stages."""
