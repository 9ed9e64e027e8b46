"""Structured Streaming drivers for the ingest and persist flows."""
