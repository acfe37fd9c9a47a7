"""Composed reports and the named query catalog."""
