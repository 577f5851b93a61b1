"""Operator 5: mix sources to target weights by Poisson replication (DataFrame functions only).

A source with share ``w`` of the target and ``c`` of the corpus (both in
characters) is to appear ``w / c * size`` times.  Each document draws its
number of copies by inverting the Poisson distribution with that mean at a
number hashed from its id, and the copies are shuffled globally by a hash of
id and copy number.  The draw of a document depends on nothing but its id,
its source's rate and the seed.

Defined cases: a null or unlisted source has weight 0 when weights are given
(its documents go); without weights every source, null among them, weighs the
same; null and empty texts measure one character, so a source of empty texts
still has a rate; a null id draws as the text ``null``; repeated rows draw
alike; an empty table gives an empty result; other columns are kept as they are.
Rates have no bound: a source's table has about ``24 * sqrt(rate)`` entries, and a
document of more than ``CHUNK`` copies is listed by several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import prepare, text_column, written

SEED = "mix-1"
TAIL_SIGMAS = 12
CHUNK = 1 << 16  # copies of a document listed by one task at a time


def source_rates(docs: DataFrame, source_col: str = "source", text_col: str = "text",
                 weights: Mapping[str, float] | None = None, size: float = 1.0) -> DataFrame:
    """``_source, chars, rate``: mean copies of a document of each source; one row per source."""
    chars = docs.groupBy(F.col(f"`{source_col}`").alias("_source")).agg(
        F.sum(F.greatest(F.length(text_column(text_col)), F.lit(1))).alias("chars"))
    if weights is None:
        weighted = chars.withColumn("_w", F.lit(1.0))
    else:
        pairs = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]) \
            if weights else F.create_map().cast("map<string,double>")
        weighted = chars.withColumn("_w", F.coalesce(pairs[F.col("_source")], F.lit(0.0)))
    # a row per source, written so that it is summed once more without reading the texts again
    weighted = written(weighted, "mixing-sources")
    total = weighted.agg(F.sum("chars").alias("a"), F.sum("_w").alias("w")).first()
    if not total.w:
        return weighted.select("_source", "chars", F.lit(0.0).alias("rate"))
    rate = F.col("_w") / F.lit(float(total.w)) * F.lit(total.a) * F.lit(float(size)) / F.col("chars")
    return weighted.select("_source", "chars", rate.alias("rate"))


def poisson_tables(rates: DataFrame) -> DataFrame:
    """``_source, _low, _cdf``: cumulative Poisson probabilities of ``_low``, ``_low + 1``, ... for each source's rate.

    The table reaches ``TAIL_SIGMAS`` deviations to either side of the mean, outside
    of which no 52-bit number falls: its length follows the root of the rate.  It is
    a row a count, summed by a window over the source, and gathered at the end.
    Logarithms are relative to the term at 0, or, if that is outside, to the term at
    the mean by Stirling's series, so that large means neither underflow nor cancel.
    """
    rate, k = F.col("rate"), F.col("_k")
    reach = TAIL_SIGMAS * F.sqrt(rate) + 30
    spans = rates.select("_source", "rate", F.greatest(F.floor(rate - reach), F.lit(0)).cast("long").alias("_low"),
                         F.ceil(rate + reach).cast("long").alias("_top"), F.floor(rate).cast("long").alias("_mean"))
    rows = spans.withColumn("_k", F.explode(F.sequence("_low", "_top")))
    up = Window.partitionBy("_source").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_d", F.sum(F.when(k > F.col("_low"), F.log(rate / F.greatest(k, F.lit(1)))).otherwise(F.lit(0.0))).over(up))
    m = F.greatest(F.col("_mean"), F.lit(1)).cast("double")
    at_mean = m * F.log(rate / m) - (rate - m) - F.log(m * (2 * math.pi)) / 2 - 1 / (12 * m) + 1 / (360 * m * m * m)
    base = F.max(F.when(k == F.col("_mean"), F.col("_d"))).over(Window.partitionBy("_source"))
    rows = rows.withColumn("_p", F.exp(F.when(F.col("_low") == 0, F.col("_d") - rate).otherwise(at_mean + F.col("_d") - base)))
    cdf = rows.withColumn("_c", F.sum("_p").over(up)).groupBy("_source").agg(
        F.min("_k").alias("_low"), F.array_sort(F.collect_list(F.struct("_k", "_c"))).alias("_cdf"))
    return cdf.select("_source", "_low", F.col("_cdf._c").alias("_cdf"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 over the parts."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def replicate(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
              weights: Mapping[str, float] | None = None, size: float = 1.0, seed: str = SEED) -> DataFrame:
    """``doc`` (the whole row as a struct), ``copies``, ``copy``, ``order_key``: a row per copy, globally shuffled.

    The rate table has a row per source; it is written first, so that Spark
    knows its size when it picks the join (broadcast only below its threshold).
    """
    prepare(docs.sparkSession)
    rates = source_rates(docs, source_col, text_col, weights, size).where("rate > 0")
    drawn = written(poisson_tables(rates.select("_source", "rate")), "mixing-rates")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.col(f"`{id_col}`").cast("string").alias("_id"), F.col(f"`{source_col}`").alias("_src"))
    joined = rows.join(drawn, F.col("_src").eqNullSafe(F.col("_source")))
    u = uniform(F.lit(seed), F.col("_id"))
    counted = joined.select("doc", "_id", (F.col("_low") + F.size(F.filter("_cdf", lambda c: c <= u))).alias("copies")).where("copies > 0")
    copy = F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    exploded = counted.where(F.col("copies") <= CHUNK).select("doc", "_id", "copies", copy)
    if drawn.where(F.col("_low") + F.size("_cdf") > CHUNK).limit(1).count():
        # documents of very many copies: listed in chunks that are dealt over the tasks
        chunks = counted.where(F.col("copies") > CHUNK).withColumn(
            "_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(CHUNK).cast("long")))) \
            .repartition(F.xxhash64("_id", "_from"))
        copy = F.explode(F.sequence(F.col("_from") + 1, F.least(F.col("_from") + CHUNK, "copies"))).alias("copy")
        exploded = exploded.unionByName(chunks.select("doc", "_id", "copies", copy))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.coalesce("_id", F.lit("null")),
                            F.col("copy").cast("string")).cast("binary"))
    return exploded.select("doc", "copies", "copy", key.alias("order_key")) \
        .repartition(F.col("order_key")).sortWithinPartitions("order_key")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``."""
    return replicate(docs, **options).select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
