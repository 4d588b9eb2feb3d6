"""Retail operators: functions from DataFrames to DataFrames."""
