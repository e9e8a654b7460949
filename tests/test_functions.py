"""Column functions: stated inputs and results."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from siftline.functions import (collapse_ws, item_id, noise_match, parse_date, rate_pct, ratio_pct_even,
                                strip_html, usable_patterns, ustrip)

# text, without white space at its ends, with single spaces, without markup
TEXTS = [("  a  b ", "a  b", "a b", "a b"), ("\ta b c\n", "a b c", "a b c", "a b c"),
         ("x\x1cy\x1fz", "x\x1cy\x1fz", "x y z", "x y z"), ("", "", "", ""), (" ", "", "", ""),
         ("\u3000lead", "lead", "lead", "lead"), ("trail\xa0", "trail", "trail", "trail"),
         ("<p>Hello <b>big</b> world</p>", "<p>Hello <b>big</b> world</p>", "<p>Hello <b>big</b> world</p>", "Hello big world"),
         ("a<br/>b", "a<br/>b", "a<br/>b", "ab"),
         ("<script>var x=1;</script>keep", "<script>var x=1;</script>keep", "<script>var x=1;</script>keep", "var x=1;keep"),
         ("&amp; <i>x</i>", "&amp; <i>x</i>", "&amp; <i>x</i>", "&amp; x")]


def test_ustrip_collapse_strip_html(spark):
    df = spark.createDataFrame(TEXTS, "t string, s string, c string, h string")
    got = df.select("t", ustrip("t").alias("s"), collapse_ws("t").alias("c"), strip_html("t").alias("h")).collect()
    assert [tuple(r) for r in got] == TEXTS


IDS = ["https://Ex.org/a/", "https://ex.org/a", " HTTPS://EX.ORG/a// ", "", "/"]


def test_item_ids(spark):
    got = spark.createDataFrame([(u,) for u in IDS], "u string").select(item_id("u").alias("i")).collect()
    assert len({r.i for r in got[:3]}) == 1 and all(len(r.i) == 16 for r in got)
    assert [r.i[:8] for r in got[3:]] == ["e3b0c442"] * 2           # the digest of nothing


# text, its date, and the date with the original's test for a T anywhere
DATES = [("", "", ""), ("2024-03-05T10:00:00Z", "2024-03-05", "2024-03-05"),
         ("Mon, 02 Dec 2024 10:00:00 GMT", "2024-12-02", "Mon, 02 De"),
         ("Wed, 04 Dec 2024 23:30:00 -0500", "2024-12-04", "2024-12-04"),
         ("Fri, 06 Dec 2024 01:00:00 +1400", "2024-12-06", "2024-12-06"), ("2024-03-05", "2024-03-05", "2024-03-05"),
         ("yesterday", "yesterday", "yesterday"), ("Sat, 7 Dec 2024 08:00:00 +0000", "2024-12-07", "2024-12-07"),
         ("Mon, 02 Dec 24 10:00:00 +0000", "2024-12-02", "2024-12-02"), ("2 Dec 99 10:00", "1999-12-02", "1999-12-02"),
         ("2 December 2024 10:00:00 GMT", "2024-12-02", "2 December"),
         ("Mon, 02-Dec-2024 10:00:00 +0000", "2024-12-02", "2024-12-02"), ("02 Dec 2024", "02 Dec 202", "02 Dec 202"),
         ("Dec 2, 2024 10:00:00", "2024-12-02", "2024-12-02"), ("Mon Dec  2 10:00:00 2024", "2024-12-02", "2024-12-02"),
         ("Mon, 31 Feb 2024 10:00:00 +0000", "Mon, 31 Fe", "Mon, 31 Fe"), ("soon, 1 May be 10:00", "soon, 1 Ma", "soon, 1 Ma")]


def test_parse_date_both_modes(spark):
    df = spark.createDataFrame(DATES, "d string, p string, c string")
    got = df.select("d", parse_date("d").alias("p"), parse_date("d", compat=True).alias("c")).collect()
    assert [tuple(r) for r in got] == DATES


PATTERNS = [(r"(?P<q>ab)(?P=q)", "xababx", "abab"[:3]), (r"x{,3}y", "zxxy", "z"), (r"a(?#note)b", "ab", "a b"),
            (r"(b)\1", "abba", "aba"), (r"[[]x]", "[x]", "x]"), (r"[]a]b", "]b", "b"), (r"end\Z", "the end", "ends"),
            (r"(?P<first_one>a)c(?P=first_one)", "aca", "acb"), (r"\(literal\)", "(literal)", "literal")]


def test_patterns_mean_what_they_mean_in_python(spark):
    import re
    usable = usable_patterns([p for p, _, _ in PATTERNS] + ["[unclosed", "(?P<x"], spark)
    assert len(usable) == len(PATTERNS)
    for (p, yes, no), java in zip(PATTERNS, usable):
        assert re.search(p, yes) and not re.search(p, no), p
        row = spark.createDataFrame([(yes, no)], "y string, n string").select(
            noise_match(F.lit(""), "y", [java]).alias("y"), noise_match(F.lit(""), "n", [java]).alias("n")).first()
        assert tuple(row) == (True, False), p


def test_group_numbers_are_a_pattern_s_own(spark):
    row = spark.createDataFrame([("abba",)], "t string").select(
        noise_match("t", F.lit(""), ["(foo)", r"(b)\1"]).alias("m")).first()
    assert row.m


def test_a_pattern_java_cannot_run_is_an_error(spark):
    with pytest.raises(ValueError, match="no counterpart"):
        usable_patterns([r"(a)?(?(1)b|c)"], spark)


def test_rates_match_sqlite_and_python(spark):
    pairs = [(a, t) for t in range(0, 81) for a in range(0, t + 1)] + [(57, 200), (1, 8)]
    df = spark.createDataFrame(pairs, "a long, t long")
    got = {(r.a, r.t): (r.p, r.e) for r in
           df.select("a", "t", rate_pct("a", "t").alias("p"), ratio_pct_even("a", "t").alias("e")).collect()}
    con = sqlite3.connect(":memory:")
    for (a, t), (p, e) in got.items():
        want = con.execute("SELECT CASE WHEN ? > 0 THEN ROUND(CAST(? AS REAL) / ?, 2) ELSE 0 END",
                           (t, a, t)).fetchone()[0]
        assert p == int(f"{want:.0%}".rstrip("%")), (a, t)
        if t:
            assert e == int(f"{a / t:.0%}".rstrip("%")), (a, t)
