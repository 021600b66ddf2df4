"""Structured Streaming jobs: raw, cleaned and aggregated layers, alerts, windows."""
