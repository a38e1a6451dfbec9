"""Whole jobs: building facts, landing feeds, rebuilding the lakehouse."""
