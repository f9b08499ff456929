"""The queries."""
