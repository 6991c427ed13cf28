"""Structured Streaming jobs: change streams to metrics, crawl messages to work."""
