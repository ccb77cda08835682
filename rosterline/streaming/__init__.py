"""Structured Streaming jobs: registration events, duplicate suppression and the error digest."""
