"""Structured Streaming forms of the landing -> fact load."""

from reelmart.streaming.landing_stream import latest_version, start_fact_stream
from reelmart.streaming.newest_stream import newest_loads, start_newest_stream

__all__ = ["latest_version", "newest_loads", "start_fact_stream", "start_newest_stream"]
