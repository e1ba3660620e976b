"""Structured Streaming twins of the log and batch operators."""
