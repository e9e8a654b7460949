"""The registered queries of this subpackage: one for each operator, with its
production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers

from .bigru_langid import identify
from .common import table
from .dac_tokens import encode_documents
from .hnsw_search import nearest_of_every
from .hyperminhash_dedup import near_duplicates
from .katz_lm import score
from .lexical_search import rank_documents
from .lpt_shards import shard_by_size
from .phrase_streams import mine_phrases
from .product_search import top_products
from .soft_mixing import mix_rates
from .string_tiling import find_leaks
from .token_attribution import count_tokens
from .warc_salvage import archive_pages

#: fixed by the query contracts
TOKENIZER = "byte_bpe_50k.json"


def op1_dac_tokens(spark, sf_dir):
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=0)


def op2_token_attribution(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_lpt_shards(spark, sf_dir):
    return shard_by_size(table(spark, sf_dir, "documents"), n_shards=24)


def op4_katz_lm(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"))


def op5_hnsw(spark, sf_dir):
    return nearest_of_every(table(spark, sf_dir, "embeddings"), divisor=50, k=5)


def op6_string_tiling(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_hyperminhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op8_bigru_langid(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


def op9_soft_mixing(spark, sf_dir):
    return mix_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc_salvage(spark, sf_dir):
    return archive_pages(table(spark, sf_dir, "pages"))


def op11_phrase_streams(spark, sf_dir):
    return mine_phrases(table(spark, sf_dir, "documents"))


def op12_norm_buckets(spark, sf_dir):
    return top_products(table(spark, sf_dir, "embeddings"), divisor=50, k=5)


def op13_impact_buckets(spark, sf_dir):
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {f.__name__: f for f in (op1_dac_tokens, op2_token_attribution, op3_lpt_shards, op4_katz_lm, op5_hnsw, op6_string_tiling,
                                   op7_hyperminhash, op8_bigru_langid, op9_soft_mixing, op10_warc_salvage, op11_phrase_streams, op12_norm_buckets,
                                   op13_impact_buckets)}

ORACLE: dict[str, str] = {}

ORACLE["op7_hyperminhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
           WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
           ELSE list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' ')) END) AS shingles
  FROM w
),
e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(shingles) AS bigint) AS n_shingles,
       least(s.doc_id, COALESCE(m, s.doc_id)) AS component_id, s.doc_id <= COALESCE(m, s.doc_id) AS kept
FROM s LEFT JOIN least ON s.doc_id = least.a"""

ORACLE["op10_warc_salvage"] = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS html, sha1(COALESCE(html, '')) AS hex FROM pages),
d AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id,
         array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
           CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS bigint), 5) AS integer) >> CAST(15 - 5 * (i % 4) AS integer)) & 31 AS bigint), 1)),
           '') AS payload_digest
  FROM p
)
SELECT page_id, CAST(octet_length(encode(html)) AS bigint) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d"""


ORACLE["op11_phrase_streams"] = r"""
WITH p AS (
  SELECT COALESCE(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
q AS (SELECT lang, row_number() OVER () AS piece_id, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
w AS (SELECT lang, piece_id, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM q),
t AS (
  SELECT lang, w1, lead(w1, 1) OVER (PARTITION BY piece_id ORDER BY i) AS w2,
         lead(w1, 2) OVER (PARTITION BY piece_id ORDER BY i) AS w3 FROM w
),
g AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM t
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM t WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM t WHERE w3 IS NOT NULL
),
f AS MATERIALIZED (SELECT lang, k, phrase, lang || chr(10) || phrase AS key, count(*) AS f FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(f) AS bigint) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 10),
cuts AS MATERIALIZED (
  SELECT lang, phrase, a, cut, lang || chr(10) || array_to_string(ws[1:cut], ' ') AS first_key,
         lang || chr(10) || array_to_string(ws[cut + 1:], ' ') AS rest_key
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)
),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cut, x.f AS l, y.f AS r,
         CAST((CAST(1000000 AS hugeint) * a * a) // (CAST(x.f AS hugeint) * y.f) AS bigint) AS score
  FROM cuts JOIN f x ON x.key = first_key JOIN f y ON y.key = rest_key
),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
wide AS (
  SELECT lang, part, max(a) AS wider FROM (
    SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS part FROM c WHERE k = 3)
  GROUP BY lang, part
)
SELECT least.lang, row_number() OVER (PARTITION BY least.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM least JOIN n ON n.lang = least.lang LEFT JOIN wide ON wide.lang = least.lang AND part = phrase
WHERE COALESCE(100 * wider < 50 * a, true)
QUALIFY rank <= 2000"""

ORACLE["op12_norm_buckets"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS double)) AS bigint)) AS x FROM embeddings
  WHERE len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
),
e AS (SELECT vec_id, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS bigint) AS score
  FROM e q JOIN e c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS integer) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""

_TERMS = r"""regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE["op13_impact_buckets"] = f"""
WITH d AS (SELECT doc_id, {_TERMS.format(text="COALESCE(text, '')")} AS terms FROM documents),
e AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
      FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY doc_id, term),
c AS (SELECT CAST(count(*) AS bigint) AS docs, CAST(sum(len(terms)) AS bigint) AS total FROM d WHERE len(terms) > 0),
i AS MATERIALIZED (SELECT DISTINCT item_id, unnest({_TERMS.format(text="COALESCE(text, '')")}) AS term FROM benchmark),
w AS MATERIALIZED (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS double) / CAST(2 * count(*) + 1 AS double))) AS bigint) AS w
  FROM e, c WHERE term IN (SELECT term FROM i) GROUP BY term, docs
),
s AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // total))))) AS bigint) AS score
  FROM i JOIN w USING (term) JOIN e USING (term), c GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS integer) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10"""
