"""Incremental landing with Structured Streaming (ST1)."""

from .landing import EpochSink, land_increments  # noqa: F401
