"""Payload parsers on hand-made edge bodies."""

import json

import pytest

from siftline.operators import scoring as sc
from siftline.sources import json_feeds as jf
from siftline.sources import xml_feeds as xf


def _raw(spark, bodies):
    return spark.createDataFrame([(0, i, f"f{i}", "d", b) for i, b in enumerate(bodies)],
                                 "sweep_id long, fetch_seq long, feed_name string, domain string, body string")


def test_rss_edges(spark):
    bodies = [
        '<rss><channel><item><title> A &amp; B </title><link>http://a/1</link><link>http://a/2</link>'
        '<description><![CDATA[<p>hi</p>  there]]></description>'
        '<pubDate>Mon, 02 Dec 2024 10:00:00 GMT</pubDate></item>'
        '<item><title>  </title><link>http://skip</link></item></channel></rss>',
        '<rss><channel><item><title>truncated',
        '<rdf:RDF xmlns:rdf="r" xmlns="http://purl.org/rss/1.0/"><item><title>R1</title></item></rdf:RDF>',
    ]
    rows = xf.feed_items(_raw(spark, bodies)).orderBy("fetch_seq", "pos").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.title, r.url, r.summary, r.published, r.source) == ("A & B", "http://a/1", "hi there",
                                                                   "2024-12-02", "rss:f0")


def test_atom_edges_and_compat(spark):
    body = ('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>E1</title>'
            '<link href="http://e/1"/><link href="http://e/2"/><summary>sum</summary>'
            '<published>2024-01-02T00:00:00Z</published><updated>2024-02-03T00:00:00Z</updated></entry></feed>')
    prefixed = ('<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry><a:title>P</a:title>'
                '<a:link href="http://p"/></a:entry></a:feed>')
    raw = _raw(spark, [body, prefixed])
    d = {r.title: r for r in xf.feed_items(raw).collect()}
    assert d["E1"].url == "http://e/1" and d["E1"].summary == "sum" and d["E1"].published == "2024-01-02"
    assert d["P"].url == "http://p"
    c = {r.title: r for r in xf.feed_items(raw, atom_compat=True).collect()}
    assert c["E1"].summary == "" and c["E1"].published == "2024-02-03"


def test_arxiv_whitespace_and_missing(spark):
    body = ('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>  A\n  paper </title>'
            '<summary> s\n\n t </summary><id> http://arxiv/1 </id><published>2024-05-06T07:08:09Z</published>'
            '</entry><entry><summary>no title</summary></entry><entry><title>B</title></entry></feed>')
    rows = xf.arxiv_items(_raw(spark, [body]).drop("feed_name")).orderBy("pos").collect()
    assert [(r.title, r.summary, r.url, r.published) for r in rows] == [
        ("A paper", "s t", "http://arxiv/1", "2024-05-06"), ("B", "", "", "")]


def test_fetch_log_counts_titled_items(spark):
    raw = spark.createDataFrame(
        [("n", "http://f", None, 1, None, None,
          '<rss><channel><item><title>x</title></item><item><title></title></item></channel></rss>'),
         ("n", "http://f", None, 2, 404, "Not Found", None)],
        "feed_name string, feed_url string, sweep_ts timestamp, fetch_seq long, status_code int, "
        "error string, body string")
    rows = sorted(xf.fetch_log_rows(raw).collect(), key=lambda r: r.seq)
    assert (rows[0].ok, rows[0].item_count) == (True, 1)
    assert (rows[1].ok, rows[1].status_code, rows[1].item_count) == (False, 404, 0)


def test_hn_shadowing_and_nulls(spark):
    hits = {"hits": [
        {"url": "http://a", "objectID": "1", "points": 10, "title": "low"},
        {"url": "http://a", "objectID": "2", "points": 99, "title": "same url later"},
        {"url": None, "objectID": "3", "points": None, "title": None, "created_at": None},
        {"url": "", "objectID": "4", "points": 70, "title": "t4", "num_comments": 5,
         "created_at": "2024-01-01T00:00:00Z"}]}
    raw = spark.createDataFrame([(0, 0, "q", json.dumps(hits))], "sweep_id long, query_seq long, query string, body string")
    out = jf.hn_search_items(jf.hn_search_hits(raw, {"q": "dom"})).collect()
    assert [(r.object_id, r.url, r.summary, r.domain, r.published) for r in out] == [
        ("4", "https://news.ycombinator.com/item?id=4", "70 points, 5 comments on HN", "dom", "2024-01-01")]


def test_serp_dedup_before_skip(spark):
    body = {"news_results": [{"link": "http://SPAM/x", "title": "a"}, {"link": "http://ok", "title": "b"}],
            "organic_results": [{"link": "http://ok", "title": "dup"}, {"title": "nolink"}]}
    raw = spark.createDataFrame([(0, 0, "q", json.dumps(body)), (0, 1, "", json.dumps(body))],
                                "sweep_id long, query_seq long, query string, body string")
    out = jf.serp_items(jf.serp_results(raw), ["SPAM"]).orderBy("pos").collect()
    assert [(r.url, r.title) for r in out] == [("http://ok", "b"), ("", "nolink")]


def test_score_response_parsing(spark):
    batched = spark.createDataFrame([(0, b, i, b * 10 + i) for b in range(5) for i in range(3)],
                                    "sweep_id long, batch long, idx long, seq long")
    responses = spark.createDataFrame([
        (0, 0, 'Sure! [{"idx": 0, "score": 5, "tier": "RED", "why": "x"}, {"idx": 0, "score": 4}] bye'),
        (0, 1, "no json here"),
        (0, 2, "[]"),
        (0, 3, '[{"score": 4}]'),
        (0, 4, 'text [1, 2] then [{"idx": 2, "score": 3, "tier": "YELLOW"}]'),
    ], "sweep_id long, batch long, response string")
    out = {(r.batch, r.idx): (r.score, r.tier, r.reason)
           for r in sc.apply_scores(batched, responses).collect()}
    assert out[(0, 0)] == (4, "YELLOW", "")            # repeated idx: the last wins, defaults fill in
    assert out[(0, 1)] == (2, "YELLOW", "unscored")
    assert out[(1, 0)] == (2, "YELLOW", "scoring failed")
    assert out[(2, 1)] == (2, "YELLOW", "unscored")    # empty array is a success
    assert out[(3, 0)] == (2, "YELLOW", "scoring failed")  # element without idx fails the batch
    assert out[(4, 2)] == (3, "YELLOW", "")
    none = {r.reason for r in sc.apply_scores(batched, None).collect()}
    assert none == {"unscored -- no API key"}


def test_rss_declaring_atom_prefix_still_parses(spark):
    body = ('<?xml version="1.0"?><rss version="2.0" xmlns:atom="http://www.w3.org/2005/Atom"><channel>'
            '<atom:link href="http://self" rel="self"/><item><title>T</title><link>http://real</link>'
            '<atom:link href="http://wrong"/></item></channel></rss>')
    rows = xf.feed_items(_raw(spark, [body])).collect()
    assert [(r.title, r.url) for r in rows] == [("T", "http://real")]


def _deep(spark, body):
    raw = spark.createDataFrame([(1, 0, "f", "d", body)], "sweep_id long, fetch_seq long, feed_name string, domain string, body string")
    return [(r.title, r.url, r.summary) for r in xf.rss_items(raw).orderBy("pos").collect()]


@pytest.mark.parametrize("body,want", [
    ('<rss><channel><group><item><title>A</title><link>http://a</link></item></group><item><title>B</title></item></channel></rss>',
     [("A", "http://a", ""), ("B", "", "")]),                                                   # below another element
    ('<rss><channel><item><title>A</title></item></channel><channel><item><title>B</title></item></channel></rss>',
     [("A", "", ""), ("B", "", "")]),                                                           # two channels
    ('<x xmlns:m="u"><y><z><item id="1"><m:c>no</m:c><title>A &amp; B</title><description>d &lt;b&gt;e</description></item></z></y></x>',
     [("A & B", "", "d e")]),
    ('<rss><channel><item><title>A</title><item><title>B</title></item></item></channel></rss>', [("A", "", ""), ("B", "", "")]),
    ('<rss><a><!-- <item><title>no</title></item> --><item><title>A</title></item><item/></a></rss>', [("A", "", "")]),
    ('<rss><a><item><title>A</title></item></a><b></rss>', []),                                  # malformed
    ('<rss><a xmlns="urn:x"><item><title>A</title></item></a></rss>', []),                       # in a namespace
    ('<rss><channel><item><title>A</title><description><![CDATA[<item>x</item>]]></description></item></channel></rss>', [("A", "", "x")]),
])
def test_items_at_any_depth(spark, body, want):
    assert _deep(spark, body) == want
