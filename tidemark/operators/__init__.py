"""Catalogue operators: functions from DataFrames to DataFrames."""
