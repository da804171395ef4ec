"""Continuously maintained tag index."""
