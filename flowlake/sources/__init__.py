"""Readers: message topics, files queried in place, bulk files."""
