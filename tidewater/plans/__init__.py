"""Composed staging and mart transformations."""
