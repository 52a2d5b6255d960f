"""Incremental loading of landed pages."""

from hydroflow.streaming.landing import load_landed_pages, stream_observations

__all__ = ["load_landed_pages", "stream_observations"]
