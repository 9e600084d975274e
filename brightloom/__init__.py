"""Reusable analysis operators for Spark DataFrames, batch and streaming."""
