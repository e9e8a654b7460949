"""Canonical item id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, ustrip


def canonical_url(url) -> Column:
    """strip -> lower -> drop every trailing '/'. Scheme, host case after
    lowering, query string and fragment are all kept."""
    return F.rtrim(F.lower(ustrip(col_(url))), F.lit("/"))


def item_id(url) -> Column:
    """16 hex chars of SHA-256 of the canonical URL."""
    return F.substring(F.sha2(canonical_url(url), 256), 1, 16)
