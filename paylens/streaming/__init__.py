"""Structured Streaming: ingest, windows, sinks, and alarms over stored counts."""
