"""Marts: plain functions from DataFrames to DataFrames."""
