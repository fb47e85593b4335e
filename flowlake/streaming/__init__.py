"""Structured Streaming jobs, windowed counts and progress."""
