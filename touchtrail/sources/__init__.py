"""Readers and the landing table."""
