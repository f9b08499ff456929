"""Readers for event tables."""
