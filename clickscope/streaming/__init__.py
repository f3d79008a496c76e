"""Structured Streaming jobs of the ad-click stream."""
