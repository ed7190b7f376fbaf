"""Readers and the shaping of what they return."""
