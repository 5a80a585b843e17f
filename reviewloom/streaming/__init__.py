"""Moderation of submissions as they arrive."""
