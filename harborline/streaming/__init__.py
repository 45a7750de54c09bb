"""Structured Streaming jobs: intake channels, processing, alerts."""
