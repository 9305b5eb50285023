"""Registered queries of the training-data operators: thin digests.

Each query applies its operator, with production parameters, to its whole
table and keeps the digest columns. ``ORACLE`` holds DuckDB SQL where SQL can
express the result on whole tables; the others are tested against brute-force
versions in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.sources.tables import read_table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op6_lpf_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by a 50-byte string of an earlier document removed."""
    from strata.llm.lpf_dedup import remove_repeated_bytes
    out = remove_repeated_bytes(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@_query
def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by a 13-word window of an earlier document removed."""
    from strata.llm.recompression import remove_repeated_words
    out = remove_repeated_words(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@_query
def op7_elias_fano_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written in doc_id order and read back."""
    import public_tokenizers
    from strata.llm.token_files import read_token_files, write_token_files
    folder, manifest = write_token_files(read_table(spark, sf_dir, "documents"),
                                         public_tokenizers.path("word_bpe_49k.json"), special_ids=True)
    return read_token_files(folder, manifest, with_ids=False)


@_query
def op10_sentencepiece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE round trip of every whole text."""
    import public_tokenizers
    from strata.llm.byte_bpe import round_trip
    return round_trip(read_table(spark, sf_dir, "documents"),
                      public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def _every_fiftieth(c):
    return c % 50 == 0


@_query
def op2_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact five largest integer inner products of every fiftieth vector."""
    from strata.llm.mtree import top_inner_products
    return top_inner_products(read_table(spark, sf_dir, "embeddings"), _every_fiftieth, k=5)


ORACLE["op2_mtree_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


@_query
def op3_vptree_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest neighbours found by cosine for every fiftieth vector."""
    from strata.llm.vptree import nearest_by_cosine
    return nearest_by_cosine(read_table(spark, sf_dir, "embeddings"), _every_fiftieth, k=5)


@_query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked by 5-word shingles at Jaccard 0.75."""
    from strata.llm.ngram_join import near_duplicate_classes
    return near_duplicate_classes(read_table(spark, sf_dir, "documents"))


@_query
def op4_multinomial_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document taken by the mix of sources."""
    from strata.llm.mixing import mixed_words
    return mixed_words(read_table(spark, sf_dir, "documents"))


@_query
def op1_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text."""
    from pyspark.sql import functions as F

    from strata.llm.crf import fit, held_out, score
    docs = read_table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
                         F.size("offsets").alias("n_spans"))


PII_KEY = b"surrogates of the corpus"


@_query
def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with surrogates in place of personal data."""
    from strata.llm.surrogates import replace_pii
    out = replace_pii(read_table(spark, sf_dir, "documents"), PII_KEY)
    return out.select("doc_id", "text", "n_entities")


# Bytes as pairs of hex digits; p: 1-based byte position.
ORACLE["op6_lpf_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
b AS (SELECT doc_id, hx, len(hx) // 2 AS n FROM d),
w AS (SELECT doc_id, p, substr(hx, 2 * p - 1, 100) AS k
      FROM (SELECT doc_id, hx, unnest(range(1, n - 48)) AS p FROM b)),
f AS (SELECT k, min(doc_id) AS m FROM w GROUP BY k),
hit AS (SELECT w.doc_id, w.p FROM w JOIN f USING (k) WHERE f.m < w.doc_id),
grp AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS g
        FROM (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM hit)),
span AS (SELECT doc_id, g, min(p) AS a, max(p) + 49 AS z FROM grp GROUP BY doc_id, g),
cut AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span),
kept AS (SELECT c.doc_id, string_agg(substr(b.hx, 2 * before + 1, 2 * (a - before - 1)), '' ORDER BY a) AS hx,
                max(z) AS last, CAST(sum(z - a + 1) AS BIGINT) AS gone, count(*) AS spans
         FROM cut c JOIN b USING (doc_id) GROUP BY c.doc_id)
SELECT b.doc_id, b.n AS n_bytes, coalesce(k.gone, 0) AS n_removed, coalesce(k.spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN k.doc_id IS NULL THEN b.hx ELSE k.hx || substr(b.hx, 2 * k.last + 1) END)) AS kept_sha256
FROM b LEFT JOIN kept k USING (doc_id)
"""

ORACLE["op8_recompression"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM d)),
f AS (SELECT k, min(doc_id) AS m FROM w GROUP BY k),
hit AS (SELECT DISTINCT doc_id, p + unnest(range(0, 13)) AS p
        FROM (SELECT w.doc_id, w.p FROM w JOIN f USING (k) WHERE f.m < w.doc_id)),
u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM d),
kept AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.p) AS text, count(*) AS n
         FROM u ANTI JOIN hit ON u.doc_id = hit.doc_id AND u.p = hit.p GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""

ORACLE["op9_ngram_jaccard"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 4], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS p FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
e AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
      WHERE 100 * common >= 75 * (p.n + q.n - common)),
both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach(doc_id, c) AS (SELECT DISTINCT x, x FROM both_ways
                     UNION SELECT r.doc_id, w.y FROM reach r JOIN both_ways w ON w.x = r.c)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(r.c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id) r USING (doc_id)
"""


@_query
def op13_fp_tree_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of every language, with its strongest terms."""
    from strata.llm.source_divergence import source_divergence
    return source_divergence(read_table(spark, sf_dir, "documents"))


ORACLE["op13_fp_tree_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT id, lang, source, unnest(ws) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lc FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
c AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
v AS (SELECT lang, count(*) AS v, sum(lc) AS ln FROM k GROUP BY lang),
g AS (SELECT g.lang, g.source, coalesce(n.n, 0) AS n, coalesce(v.v, 0) AS v, coalesce(v.ln, 0) AS ln
      FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN n USING (lang, source) LEFT JOIN v USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
             1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 1)) // (g.n + g.v) AS p,
             1 + (CAST(1000000000 AS HUGEINT) * (k.lc + 1)) // (g.ln + g.v) AS q
      FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
      GROUP BY a.lang, a.source, b.source),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE c > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 200
"""


@_query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    from strata.llm.conversation_trie import conversation_trie
    return conversation_trie(read_table(spark, sf_dir, "conversations"))


# crc: CRC-32 of the decimal conv_id, bit by bit; its last two bits are h.
# key: digest of a rebuilt conversation's first d turns.
ORACLE["op12_conversation_trie"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(sha256(len(role) || ':' || role || text) ORDER BY turn NULLS FIRST, role, text) AS ids,
             list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY turn NULLS FIRST, role, text) AS ns
      FROM t GROUP BY conv_id),
h AS (SELECT *, conv_id - conv_id % 20 AS head_id,
             xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                 lambda c: CAST(ord(c) AS BIGINT)),
               lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0],
                 lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 4 AS h FROM o),
r AS (SELECT h.conv_id, coalesce(d.ids[1:h.h], []) || h.ids[h.h + 1:] AS ids,
             coalesce(d.ns[1:h.h], []) || h.ns[h.h + 1:] AS ns
      FROM h LEFT JOIN o d ON d.conv_id = h.head_id),
p AS (SELECT conv_id, d, len(ids) AS len, sha256(array_to_string(ids[1:d], '')) AS key,
             sha256(array_to_string(ids[1:d - 1], '')) AS up, CASE WHEN d = 0 THEN 0 ELSE ns[d] END AS words
      FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM r)),
n AS (SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(up) AS up, any_value(words) AS words,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len = d), '')) AS ends
      FROM p GROUP BY key, d),
k AS (SELECT up, d - 1 AS d, count(*) AS kids FROM n WHERE d > 0 GROUP BY up, d),
f AS (SELECT n.*, coalesce(k.kids, 0) AS kids FROM n LEFT JOIN k ON k.up = n.key AND k.d = n.d),
s AS (SELECT p.key, p.d, sum(CASE WHEN f.kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((f.n_convs - 1) * f.words) AS saved
      FROM f JOIN p ON p.conv_id = f.conv_id AND p.d <= f.d GROUP BY p.key, p.d)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, f.n_convs, CAST(f.kids AS BIGINT) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM f JOIN s ON s.key = f.key AND s.d = f.d LEFT JOIN n u ON f.d > 0 AND u.key = f.up AND u.d = f.d - 1
"""


@_query
def op11_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of vectors at cosine 0.95 or more."""
    from strata.llm.multi_index import near_duplicate_vectors
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


ORACLE["op11_inverted_multi_index"] = """
WITH RECURSIVE u AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL),
v AS (
  SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM u
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
reach(vec_id, c) AS (SELECT DISTINCT x, x FROM l UNION SELECT r.vec_id, l.y FROM reach r JOIN l ON l.x = r.c),
m AS (SELECT vec_id, min(c) AS c FROM reach GROUP BY vec_id),
n AS (SELECT x AS vec_id, count(*) AS n FROM l GROUP BY x)
SELECT i.vec_id, coalesce(n.n, 0) AS n_links, coalesce(m.c, i.vec_id) AS component_id,
       coalesce(m.c, i.vec_id) = i.vec_id AS kept
FROM (SELECT DISTINCT vec_id FROM u) i LEFT JOIN n USING (vec_id) LEFT JOIN m USING (vec_id)
"""
