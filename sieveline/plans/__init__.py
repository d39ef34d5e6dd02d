"""Composite search request."""
