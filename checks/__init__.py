"""Registered queries with the SQL each of them is checked against."""

from .registry import REGISTRY, Check
from . import bitmaps, documents, facets, filters, lookups, requests, sorting, text, variants, vocabulary  # noqa: F401

__all__ = ["REGISTRY", "Check"]
