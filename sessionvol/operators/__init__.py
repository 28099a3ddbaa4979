"""Staging, normalisation, volatility, curves, metadata, summaries and quality checks."""
