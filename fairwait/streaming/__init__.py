"""Incremental upsert of newly landed files."""
