"""Prompt specifications and chains of steps."""
