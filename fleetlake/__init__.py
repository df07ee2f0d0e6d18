"""Telemetry lakehouse for device fleets, built on Spark DataFrames and Structured Streaming."""
