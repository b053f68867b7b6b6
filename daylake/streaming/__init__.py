"""Arrival-driven loading over the landing zone (Structured Streaming file source)."""
