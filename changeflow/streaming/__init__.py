"""Structured Streaming wrapper around the batch kernel."""
