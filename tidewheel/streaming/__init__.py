"""Structured Streaming operators and the jobs that run them."""
