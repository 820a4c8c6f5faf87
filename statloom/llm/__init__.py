"""Operators for preparing training text: filtering, deduplication, scanning and token encoding."""
