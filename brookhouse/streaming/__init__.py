"""Sinks, keyed tables, state and the streaming jobs."""
