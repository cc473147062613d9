"""Structured Streaming jobs and the runner that bounds them."""
