"""Structured Streaming drivers: micro-batch ingest and streaming hourly velocity."""
