"""Structured Streaming forms of the hourly flow."""
