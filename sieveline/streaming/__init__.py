"""Continuous indexing."""

from .index_stream import index_stream

__all__ = ["index_stream"]
