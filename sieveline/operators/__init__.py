"""Filters, text search, sorting and facets over document tables."""
