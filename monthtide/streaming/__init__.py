"""Incremental catch-up driven by arriving files."""

from monthtide.streaming.catchup import arrivals, catch_up

__all__ = ["arrivals", "catch_up"]
