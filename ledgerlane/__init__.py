"""Retail and ERP analytics jobs on Spark: plain functions from DataFrames to DataFrames."""
