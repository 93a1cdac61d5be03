"""Queries that apply the operators to their whole tables, with check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


LINE_DEDUP_SQL = r"""
  WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM {docs}),
  lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM d),
  keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
  hot AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
  marked AS (SELECT l.doc_id, l.pos, l.line, h.k IS NOT NULL AND l.doc_id <> h.keeper AS gone FROM keyed l LEFT JOIN hot h ON h.k = l.k)
"""


@query("op2_line_dedup", LINE_DEDUP_SQL.format(docs="documents") + r"""
  SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
  FROM marked GROUP BY doc_id""")
def op2(spark: SparkSession, d: str) -> DataFrame:
    from . import line_dedup

    docs = table(spark, d, "documents")
    return line_dedup.digests(docs, line_dedup.drop_bitmaps(docs))


@query("op5_packing")
def op5(spark: SparkSession, d: str) -> DataFrame:
    from . import packing

    return packing.pack(table(spark, d, "documents"), tokenizer_file())


@query("op8_simhash")
def op8(spark: SparkSession, d: str) -> DataFrame:
    from . import simhash

    return simhash.near_duplicates(table(spark, d, "documents"))


@query("op7_language_id")
def op7(spark: SparkSession, d: str) -> DataFrame:
    from . import language_id

    return language_id.train_and_identify(table(spark, d, "documents"))


@query("op6_topk", r"""
  WITH v AS (SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND NOT list_bool_or([x IS NULL OR NOT isfinite(x) FOR x IN embedding])),
  s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
    FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
  r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
  SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""")
def op6(spark: SparkSession, d: str) -> DataFrame:
    from . import topk

    vectors = table(spark, d, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


@query("op3_toxicity")
def op3(spark: SparkSession, d: str) -> DataFrame:
    from . import toxicity

    return toxicity.train_and_score(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op1_decontaminate")
def op1(spark: SparkSession, d: str) -> DataFrame:
    from . import decontaminate

    return decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op10_html_extract")
def op10(spark: SparkSession, d: str) -> DataFrame:
    from . import html_extract

    return html_extract.extract(table(spark, d, "pages"))


@query("op4_pii")
def op4(spark: SparkSession, d: str) -> DataFrame:
    from . import pii

    found = pii.find(table(spark, d, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


@query("op9_suffix_dedup")
def op9(spark: SparkSession, d: str) -> DataFrame:
    from . import suffix_dedup

    cut = suffix_dedup.remove_repeats(table(spark, d, "documents"))
    digest = F.when(F.col("kept").isNull(), F.col("sha")).otherwise(F.sha2("kept", 256))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", digest.alias("kept_sha256"))


@query("op12_warc", r"""
  WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
  d AS (SELECT page_id, html, CAST(strlen(html) AS BIGINT) AS payload_bytes, min(page_id) OVER (PARTITION BY html) AS first,
    [CAST(concat('0x', substring(sha1(html), 2 * i + 1, 2)) AS BIGINT) FOR i IN range(20)] AS b FROM p)
  SELECT page_id, payload_bytes,
    array_to_string([substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (((b[5 * i // 8 + 1] << 8)
      + coalesce(b[5 * i // 8 + 2], 0)) >> (11 - 5 * i % 8)) % 32 AS BIGINT), 1) FOR i IN range(32)], '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
  FROM d""")
def op12(spark: SparkSession, d: str) -> DataFrame:
    from . import warc

    return warc.archive_pages(table(spark, d, "pages"))


@query("op13_lexical_search", r"""
  WITH f AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents WHERE text IS NOT NULL),
  d AS (SELECT row, doc_id, words, CAST(len(words) AS BIGINT) AS n FROM f WHERE len(words) > 0),
  whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
  tf AS (SELECT row, word, count(*) AS tf FROM (SELECT row, unnest(words) AS word FROM d) GROUP BY row, word),
  item AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word FROM benchmark),
  w AS (SELECT word, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY word, n_docs),
  s AS (SELECT item_id, tf.row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS score
    FROM item JOIN tf ON tf.word = item.word JOIN w ON w.word = item.word JOIN d ON d.row = tf.row, whole GROUP BY item_id, tf.row),
  r AS (SELECT item_id, d.doc_id, s.score, row_number() OVER (PARTITION BY item_id ORDER BY s.score DESC, d.doc_id NULLS LAST) AS rank
    FROM s JOIN d ON d.row = s.row WHERE s.score > 0)
  SELECT item_id, CAST(rank AS INT) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 10""")
def op13(spark: SparkSession, d: str) -> DataFrame:
    from . import lexical

    return lexical.search(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op11_conversation_trie", r"""
  WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(concat(length(coalesce(role, '')), ':', role, text))) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
  c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce([(ascii(substring(CAST(conv_id AS VARCHAR), CAST(1 + i // 8 AS BIGINT), 1)) >> CAST(i % 8 AS INT)) & 1
        FOR i IN range(8 * length(CAST(conv_id AS VARCHAR)))], lambda a, b: xor(a >> 1, 3988292384 * (xor(a, b) & 1)), 4294967295), 4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM o)),
  s AS (SELECT c.conv_id, 0 AS part, o.pos, role, text FROM c JOIN o ON o.conv_id = c.base WHERE pos < h
    UNION ALL SELECT c.conv_id, 1, o.pos, role, text FROM c JOIN o ON o.conv_id = c.conv_id WHERE pos >= h),
  t AS (SELECT conv_id, row_number() OVER w AS depth, md5(CAST(list({'role': role, 'text': text}) OVER w AS VARCHAR)) AS node,
      CAST(len(regexp_extract_all(text, '[^ 	
]+')) AS BIGINT) AS words FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
  p AS (SELECT conv_id, depth, node, words, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM t
    UNION ALL SELECT conv_id, 0, '', 0, NULL FROM c),
  q AS (SELECT conv_id, depth, node, words, CASE WHEN depth = 1 THEN '' ELSE up END AS up, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p),
  n AS (SELECT node, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words, min(up) AS up,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM q GROUP BY node),
  k AS (SELECT up, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY up),
  below AS (SELECT q.node, count(*) FILTER (k.up IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
    FROM n JOIN q ON q.conv_id = n.conv_id AND q.depth <= n.depth LEFT JOIN k ON k.up = n.node GROUP BY q.node)
  SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
  FROM n JOIN below b ON b.node = n.node LEFT JOIN k ON k.up = n.node LEFT JOIN n m ON n.depth > 0 AND m.node = n.up""")
def op11(spark: SparkSession, d: str) -> DataFrame:
    from . import conversation_trie

    return conversation_trie.trie(table(spark, d, "conversations"))
