"""Readers: every function returns a DataFrame."""
