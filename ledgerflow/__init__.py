"""Batch and streaming analytics for cross-border transfers, written on Spark SQL."""
