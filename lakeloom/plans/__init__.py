"""Composite loads and the query catalogue run against the driver tables."""
