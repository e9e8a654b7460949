"""Date text parsing (P4) and sweep labels (P10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SWEEP_LABELS
from .text import col_, ustrip

_ISO_PREFIX = r"^\d{4}-\d{2}-\d{2}T"
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_NAME = r"(?:[a-z]+[,.]?\s+|[a-z]+,)?"
_MONTH = f"({'|'.join(_MONTHS)})[a-z]*"
_TIME = r"\d{1,2}[:.]\d{1,2}"
# day month year time (spaces or hyphens between), month day year time, month day time year; and the
# groups of day, month and year
_RFC = ((rf"(?i)^{_NAME}(\d{{1,2}})[\s-]+{_MONTH}[.,]?[\s-]+(\d{{4}}|\d{{2}}),?\s+{_TIME}", 1, 2, 3),
        (rf"(?i)^{_NAME}{_MONTH}[.,]?\s+(\d{{1,2}}),?\s+(\d{{4}}|\d{{2}}),?\s+{_TIME}", 2, 1, 3),
        (rf"(?i)^{_NAME}{_MONTH}[.,]?\s+(\d{{1,2}})\s+{_TIME}[\d:.]*\s+(\d{{4}}|\d{{2}})(?!\d)", 2, 1, 3))


def rfc822_date(c) -> Column:
    """Calendar date written in an RFC-822 date with a time, in its own offset
    (no time-zone conversion), or null. Two-digit years from 69 on are in the
    20th century, others in the 21st; full month names, hyphens, and the month
    before the day are read too."""
    x, out = col_(c), []
    for rx, day, month, year in _RFC:
        y = F.regexp_extract(x, rx, year)
        short = F.length(y) == 2
        full = F.concat(F.when(short & (y >= "69"), "19").when(short, "20").otherwise(""), y)
        m = F.array_position(F.lit(list(_MONTHS)), F.lower(F.regexp_extract(x, rx, month)))
        text = F.concat_ws("-", full, F.lpad(m.cast("string"), 2, "0"), F.lpad(F.regexp_extract(x, rx, day), 2, "0"))
        out.append(F.when(x.rlike(rx), F.try_to_date(text, "yyyy-MM-dd")))
    return F.coalesce(*out)


def parse_date(c, compat: bool = False) -> Column:
    """Publication date text -> ``YYYY-MM-DD`` where possible.

    empty -> ""; ISO date-time -> first 10 chars; RFC-822 -> its date;
    anything else -> first 10 chars. ``compat=True`` reproduces the
    original's test for a literal ``T`` anywhere in the text, which also
    catches day names such as ``Tue`` and zones such as ``GMT``.
    """
    x = ustrip(col_(c))
    iso = x.contains("T") if compat else x.rlike(_ISO_PREFIX)
    rfc = rfc822_date(x)
    return (F.when(col_(c).isNull() | (x == ""), F.lit(""))
            .when(iso, F.substring(x, 1, 10))
            .when(rfc.isNotNull(), F.date_format(rfc, "yyyy-MM-dd"))
            .otherwise(F.substring(x, 1, 10)))


def sweep_type_of(ts) -> Column:
    """Sweeps started before 10:00 are full, later ones light."""
    return F.when(F.hour(col_(ts)) < 10, F.lit("full")).otherwise(F.lit("light"))


def sweep_label(sweep_type) -> Column:
    st = col_(sweep_type)
    expr = st
    for k, v in reversed(list(SWEEP_LABELS.items())):
        expr = F.when(st == k, F.lit(v)).otherwise(expr)
    return expr


def ts_text(c) -> Column:
    """Timestamps as text with microseconds, identical across engines."""
    return F.date_format(col_(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def digest_name(ts) -> Column:
    """The file a sweep's digest is written to."""
    return F.concat(F.date_format(col_(ts), "yyyy-MM-dd_HHmm"), F.lit(".md"))
