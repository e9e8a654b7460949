"""Keyword and pattern predicates.

Keyword lists come from config, so they are compiled into the plan as
literals: one ``contains`` per keyword, all inside codegen, no Python.
"""

from __future__ import annotations

import re
from typing import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .text import col_


#: case-insensitive, Unicode-aware, and only \n ends a line, as in Python
FLAGS = "(?idU)"


def _lowered(keywords: Iterable[str]) -> list[str]:
    out, seen = [], set()
    for k in keywords:
        k = (k or "").lower()
        if k not in seen:
            seen.add(k)
            out.append(k)
    return out


def any_keyword(text, keywords: Iterable[str]) -> Column:
    """lower(text) contains any lower(keyword); plain substring, no word
    boundary; an empty keyword matches everything; no keyword -> false."""
    t = F.lower(col_(text))
    kws = _lowered(keywords)
    if not kws:
        return F.lit(False)
    expr = None
    for k in kws:
        e = t.contains(F.lit(k))
        expr = e if expr is None else (expr | e)
    return expr


def matched_keywords(text, keywords: Iterable[str], sep: str = "|") -> Column:
    """The keywords (in config order, lower-cased) found in lower(text),
    joined with ``sep``; empty string when none."""
    t = F.lower(col_(text))
    parts = [F.when(t.contains(F.lit(k)), F.lit(k)) for k in _lowered(keywords)]
    if not parts:
        return F.lit("")
    return F.concat_ws(sep, *parts)


def contains_any_raw(text, needles: Iterable[str]) -> Column:
    """Case-sensitive containment of any needle (web-search skip domains)."""
    c = col_(text)
    expr = F.lit(False)
    for n in needles:
        expr = expr | c.contains(F.lit(n))
    return expr


def blocked_site(url, skip_domains: Iterable[str]) -> Column:
    """lower(url) contains any lower(skip_domain) (F2)."""
    return any_keyword(url, skip_domains) if list(skip_domains) else F.lit(False)


def java_pattern(pattern: str) -> str:
    """A Python pattern in Java's syntax: named groups and references to them
    (names are numbered), ``{,n}``, comments, and the end anchor ``\\Z``."""
    names: dict[str, str] = {}

    def name(n: str) -> str:
        return names.setdefault(n, f"n{len(names)}")
    out, i, in_class = [], 0, False
    while i < len(pattern):
        rest = pattern[i:]
        if rest[0] == "\\":
            piece, new = rest[:2], r"\z" if rest[:2] == r"\Z" and not in_class else rest[:2]
        elif in_class:
            piece = new = rest[0]
            in_class = rest[0] != "]"
            if rest[0] in "[&":
                new = "\\" + rest[0]     # Java would open a nested class, or cut two classes
        elif rest[0] == "[":
            m = re.match(r"\[\^?\]?", rest)      # a bracket in first place is an ordinary character
            piece, new, in_class = m[0], m[0].replace("]", r"\]"), True
        elif m := re.match(r"\(\?P<(\w+)>", rest):
            piece, new = m[0], f"(?<{name(m[1])}>"
        elif m := re.match(r"\(\?P=(\w+)\)", rest):
            piece, new = m[0], rf"\k<{name(m[1])}>"
        elif m := re.match(r"\(\?#[^)]*\)", rest):
            piece, new = m[0], ""
        elif m := re.match(r"\{,(\d+)\}", rest):
            piece, new = m[0], f"{{0,{m[1]}}}"
        else:
            piece = new = rest[0]
        out.append(new)
        i += len(piece)
    return "".join(out)


def usable_patterns(patterns: Iterable[str], spark: SparkSession | None = None) -> list[str]:
    """The patterns in Java's syntax. What is no Python pattern is skipped, as
    the original does; a Python pattern that Java cannot run is an error."""
    jpat = spark.sparkContext._jvm.java.util.regex.Pattern if spark is not None else None
    out = []
    for p in patterns:
        try:
            re.compile(p, re.IGNORECASE)
        except re.error:
            continue
        java = java_pattern(p)
        if jpat is not None:
            try:
                jpat.compile(FLAGS + java)
            except Exception as e:
                raise ValueError(f"noise pattern {p!r} has no counterpart in Java: {e}") from e
        out.append(java)
    return out


def noise_regexes(patterns: Iterable[str]) -> list[str]:
    """Case-insensitive, Unicode-aware expressions: one alternation of the
    patterns without groups, and one for each pattern that has groups, whose
    numbers an alternation would shift."""
    plain, own = [], []
    for p in patterns:
        (own if re.search(r"(?<!\\)(?:\\\\)*\((?!\?[:=!#]|\?<[=!])", p) else plain).append(p)
    return ([FLAGS + "|".join(f"(?:{p})" for p in plain)] if plain else []) + [f"{FLAGS}{p}" for p in own]


def noise_match(title, summary, patterns: Iterable[str]) -> Column:
    """Search over lower(title + " " + summary)."""
    text = F.lower(F.concat_ws(" ", F.coalesce(col_(title), F.lit("")),
                               F.coalesce(col_(summary), F.lit(""))))
    hit = F.lit(False)
    for rx in noise_regexes(patterns):
        hit = hit | text.rlike(rx)
    return hit
