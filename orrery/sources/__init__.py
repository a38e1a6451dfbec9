"""Readers: JDBC, JSON and CSV files, document collections, file streams."""
