"""Text expressions (P2, P3, P5, P6, P7). All are built-in Column
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.split() sees it: Unicode white space plus the
# four information separators U+001C..U+001F.
WS_CLASS = r"[\s\x{1c}-\x{1f}]"
_WS_RUN = r"(?U)" + WS_CLASS + "+"
# Fixed value: the characters Python's str.strip()/split() treat as white
# space (Unicode White_Space plus U+001C..U+001F), as a trim set.
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 + "".join(chr(c) for c in range(0x2000, 0x200B))
                 + "\u2028\u2029\u202f\u205f\u3000")
_TAG = r"<[^>]+>"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c) -> Column:
    """Python ``str.strip()``. Spark's one-argument ``trim`` removes only
    U+0020; with a trim set it removes any of those characters from both
    ends, codegen'd, no regex."""
    return F.trim(col_(c), F.lit(PY_WHITESPACE))


def is_blank(c) -> Column:
    """True for null, empty or whitespace-only strings."""
    c = col_(c)
    return c.isNull() | (ustrip(c) == F.lit(""))


def collapse_ws(c) -> Column:
    """``" ".join(s.split())``: runs of white space to one space, ends cut."""
    return F.trim(F.regexp_replace(col_(c), _WS_RUN, " "))


def strip_html(c) -> Column:
    """Delete tags (no space inserted, entities kept) then collapse space."""
    return collapse_ws(F.regexp_replace(col_(c), _TAG, ""))


def truncate(c, n: int) -> Column:
    """First ``n`` code points, no ellipsis."""
    return F.substring(col_(c), 1, n)


def blank_to_empty(c) -> Column:
    """JSON/XML nulls are read as empty strings."""
    return F.coalesce(col_(c), F.lit(""))


def url_or_discussion(url, item_id, base: str = "https://news.ycombinator.com/item?id=") -> Column:
    """Empty or null url falls back to the discussion page."""
    u = col_(url)
    return F.coalesce(F.nullif(u, F.lit("")),
                      F.concat(F.lit(base), blank_to_empty(col_(item_id).cast("string"))))


def points_text(points, comments=None) -> Column:
    """``"<p> points, <c> comments on HN"`` or ``"<p> points on HN"``."""
    p = col_(points).cast("string")
    if comments is None:
        return F.concat(p, F.lit(" points on HN"))
    return F.concat(p, F.lit(" points, "), col_(comments).cast("string"), F.lit(" comments on HN"))


def xml_escape(c) -> Column:
    """Escape ``&``, ``<`` and ``>`` for element text."""
    c = col_(c)
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))
