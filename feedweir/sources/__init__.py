"""Readers, catalog views and writers."""
