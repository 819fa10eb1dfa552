"""Readers for lines, topics and tables."""
