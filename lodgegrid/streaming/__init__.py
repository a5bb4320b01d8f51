"""Incremental month loading on Structured Streaming's file source."""
