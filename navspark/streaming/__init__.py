"""Incremental form of the NAV ingest (landed payload documents -> NAV table)."""

from navspark.streaming.ingest import nav_stream, start_nav_ingest

__all__ = ["nav_stream", "start_nav_ingest"]
