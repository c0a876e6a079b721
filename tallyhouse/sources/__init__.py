"""Readers for the feeds and the adapter from the given tables."""
