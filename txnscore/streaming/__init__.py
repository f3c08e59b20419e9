"""Structured Streaming jobs: drain a message log, land it, score and count."""
