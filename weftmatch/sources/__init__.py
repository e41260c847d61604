"""Delimited and Parquet sources, sinks and the record view."""
