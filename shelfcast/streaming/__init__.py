"""Incremental pickup of newly landed files."""
