"""Structured Streaming over map pixels and light curves."""
