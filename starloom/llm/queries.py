"""Registered queries of the training-data operators and, where SQL can say it, their DuckDB oracles.

Each query applies its operator to the whole table with production
parameters and turns the operator's outputs into the result columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (bloom_search, content_sort, cover_tree, kneser_ney, mixing, segmentation, simhash, sketch, suffix_dedup,
                          token_counts, toxicity, url_filter, whitening)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts for all page URLs: rules first, else a regression trained on URLs that the rules decide."""
    pages = _table(spark, sf_dir, "pages")
    return url_filter.url_verdicts(pages, url_filter.judged_by_rules(pages))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every vector whose id is divisible by 20."""
    vectors = _table(spark, sf_dir, "embeddings")
    return cover_tree.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content sort over all documents: who stays, for whom, in how large a group."""
    return content_sort.content_sort_dedup(_table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents under a model counted over those not held out."""
    return kneser_ney.corpus_scores(_table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents replicated so that every source weighs the same, in shuffled order.

    The shuffle carries whole rows; the digest of the text is taken after it.
    """
    m = mixing.replicate(_table(spark, sf_dir, "documents"))
    return m.select(F.col("doc.doc_id").alias("doc_id"), F.col("doc.source").alias("source"),
                    F.col("copies").cast("int").alias("copies"), F.col("copy").cast("int").alias("copy"), "order_key", F.md5(F.coalesce(F.col("doc.text"), F.lit("")).cast("binary")).alias("text_md5"))


OP5_SQL = f"""
WITH s AS (SELECT source, sum(greatest(length(coalesce(text, '')), 1))::BIGINT AS chars FROM documents GROUP BY source),
t AS (SELECT sum(chars)::BIGINT AS a, sum(1.0::DOUBLE) AS ws FROM s),
r AS (SELECT source, 1.0::DOUBLE / ws * a * 1.0::DOUBLE / chars AS rate FROM s, t),
k AS (SELECT source, rate, unnest(range(0, ceil(rate + {mixing.TAIL_SIGMAS} * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM r),
p AS (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM k),
c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM p),
l AS (SELECT source, list(cdf ORDER BY k) AS cdf FROM c GROUP BY source),
u AS (SELECT d.*, ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
      / {1 << 52}::DOUBLE AS u FROM documents d),
n AS (SELECT doc_id, u.source, text, len(list_filter(cdf, lambda x: x <= u)) AS copies
      FROM u JOIN l ON u.source IS NOT DISTINCT FROM l.source),
e AS (SELECT *, unnest(range(1, copies + 1)) AS copy FROM n)
SELECT doc_id, source, copies::INTEGER AS copies, copy::INTEGER AS copy,
       md5('{mixing.SEED}:order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy) AS order_key,
       md5(coalesce(text, '')) AS text_md5 FROM e
"""


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from the labelled training rows."""
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document, encoded and decoded."""
    return segmentation.digests(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and the components of links at 4 or fewer bits."""
    return simhash.simhash_components(_table(spark, sf_dir, "documents"), size=4, budget=4)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suffix-summed histogram of encoded lengths of all documents."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-byte strings that start in a document with a smaller id."""
    d = suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
j AS (SELECT r, doc_id, length(h) // 2 AS n, h, unnest(range(0, length(h) // 2, 200)) AS o FROM d),
k AS (SELECT r, doc_id, n, o, substr(h, 2 * o + 1, 500) AS h FROM j),
b AS (SELECT r, doc_id, n, o, h, unnest(range(0, least(200, n - o))) AS q FROM k),
w AS (SELECT r, doc_id, o + q AS p, CASE WHEN o + q + 50 <= n THEN substr(h, 2 * q + 1, 100) END AS s,
      substr(h, 2 * q + 1, 2) AS c FROM b),
m AS (SELECT s, min(doc_id) AS lo FROM w WHERE s IS NOT NULL GROUP BY s),
f AS (SELECT w.r, w.p, w.c, coalesce(m.lo < coalesce(w.doc_id, 9223372036854775807), false) AS dup
      FROM w LEFT JOIN m ON w.s = m.s),
g AS (SELECT r, p, c, max(dup::INT) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
e AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY r ORDER BY p) AS before FROM g),
x AS (SELECT r, sum(gone)::BIGINT AS n_removed, count(*) FILTER (WHERE gone = 1 AND before = 0)::BIGINT AS n_spans,
      coalesce(string_agg(c, '' ORDER BY p) FILTER (WHERE gone = 0), '') AS kept FROM e GROUP BY r)
SELECT d.doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN x ON d.r = x.r
"""


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all documents and of their edited texts, and how alike they are."""
    return sketch.fingerprints(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


_KEPT = f"""list_sort(list_distinct(list_filter(list_transform(
    CASE WHEN len({{w}}) = 0 THEN [] ELSE range(1, greatest(len({{w}}) - {sketch.SHINGLE - 1}, 1) + 1) END,
    lambda i: substr(md5(array_to_string({{w}}[i:i + {sketch.SHINGLE - 1}], ' ')), 1, 16)), lambda h: h < '{sketch.threshold(sketch.FRACTION)}')))"""
_ALIKE = """CASE WHEN {a}_whole = {b}_whole THEN 1.0::DOUBLE
    WHEN len({a}_kept) + len({b}_kept) = 0 THEN 0.0::DOUBLE
    ELSE len(list_intersect({a}_kept, {b}_kept))::DOUBLE
         / (len({a}_kept) + len({b}_kept) - len(list_intersect({a}_kept, {b}_kept))) END"""
OP11_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, sha256(coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, ''))) AS p,
                  count(*) OVER () AS n FROM documents),
e AS (SELECT d.*, substr(d.t, 1, length(d.t) - length(d.t) // 3) || substr(x.t, 1, length(d.t) // 3) AS et, d.p % d.n + 1 AS q
      FROM d JOIN d AS x ON x.p = d.p % d.n + 1),
w AS (SELECT *, list_filter(regexp_split_to_array(lower(t), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(regexp_split_to_array(lower(et), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ew FROM e),
k AS (SELECT *, substr(md5(array_to_string(w, ' ')), 1, 16) AS a_whole, {_KEPT.format(w='w')} AS a_kept,
             substr(md5(array_to_string(ew, ' ')), 1, 16) AS b_whole, {_KEPT.format(w='ew')} AS b_kept FROM w),
j AS (SELECT k.*, x.a_whole AS c_whole, x.a_kept AS c_kept FROM k JOIN k AS x ON x.p = k.q)
SELECT doc_id, length(t) AS n_chars, sha256(et) AS edited_sha256,
       a_whole || ':' || coalesce(array_to_string(a_kept, ''), '') AS fingerprint,
       b_whole || ':' || coalesce(array_to_string(b_kept, ''), '') AS edited_fingerprint,
       {_ALIKE.format(a='a', b='b')} AS near_edited, {_ALIKE.format(a='a', b='c')} AS near_next,
       CASE WHEN len(a_kept) > 0 THEN len(list_intersect(a_kept, b_kept))::DOUBLE / len(a_kept) END AS contained_in_edited
FROM j
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened on their first 32 components."""
    w = whitening.whiten(_table(spark, sf_dir, "embeddings"), components=32)
    return w.select(F.col("id").alias("vec_id"), "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened",
                    "explained", "identity_error")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return bloom_search.search(_table(spark, sf_dir, "benchmark"), _table(spark, sf_dir, "documents"), k=20)


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
i AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS t FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT i, item_id, term, count(*) AS c FROM (SELECT i, item_id, unnest(t) AS term FROM i) GROUP BY ALL),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s),
m AS (SELECT r, doc_id, 100 - 25 + ((25 * len(t) * n_docs) // l) AS m FROM d, s WHERE len(t) > 0),
p AS (SELECT q.i, q.item_id, m.r, m.doc_id, sum(q.c * w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * m.m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""

QUERIES = {
    "op1_url_filter": (op1_url_filter, None),
    "op2_top_k": (op2_top_k, OP2_SQL),
    "op3_exact_dedup": (op3_exact_dedup, OP3_SQL),
    "op4_kneser_ney": (op4_kneser_ney, None),
    "op5_mixing": (op5_mixing, OP5_SQL),
    "op6_toxicity": (op6_toxicity, None),
    "op7_segmentation": (op7_segmentation, None),
    "op8_simhash": (op8_simhash, None),
    "op9_token_counts": (op9_token_counts, None),
    "op10_suffix_dedup": (op10_suffix_dedup, OP10_SQL),
    "op11_fingerprints": (op11_fingerprints, OP11_SQL),
    "op12_whitening": (op12_whitening, None),
    "op13_ranked_search": (op13_ranked_search, OP13_SQL),
}
