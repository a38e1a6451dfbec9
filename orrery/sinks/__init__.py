"""Catalog databases and tables."""
