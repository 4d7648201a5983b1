"""Telemetry upgrade and query jobs expressed as Spark DataFrames."""
