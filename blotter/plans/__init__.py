"""Composite pipelines (Q1-Q5) and the registered driver queries."""
