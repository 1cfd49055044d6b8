"""Bounded stream drains with Structured Streaming."""
