"""The reports: plain functions from DataFrames to a DataFrame."""
