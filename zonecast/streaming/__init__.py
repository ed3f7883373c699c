"""Streaming form of the hourly demand count (watermarked, append mode)."""
