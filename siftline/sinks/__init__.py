"""Sinks: append-only logs and digest files (K1-K5)."""

from .logs import LogStore, digest_files  # noqa: F401
