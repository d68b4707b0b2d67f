"""Incremental runs over a folder where study exports arrive (Structured Streaming)."""

from .exports import map_exports_stream

__all__ = ["map_exports_stream"]
