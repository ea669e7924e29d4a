"""Structured Streaming entry points."""

from lakeloom.streaming.landing import land_new_files

__all__ = ["land_new_files"]
