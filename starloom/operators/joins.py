"""Join patterns of the loaders (J1–J6, J10) as DataFrame joins.

Broadcast is requested only for sides with a proven bound (the date
dimension: one row per calendar day of a fixed range).  Every other
dimension is left to Spark: AQE turns a sort-merge join into a broadcast
join at runtime when the measured shuffle output is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, and splits skewed
partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def restrict_to_keys(big: DataFrame, big_col: str, keys: DataFrame, key_col: str) -> DataFrame:
    """Rows of a large table whose key occurs in ``keys`` (a batch's key set).

    A semi join on the distinct keys, without hints: Spark broadcasts the key
    set if its measured size allows and puts a runtime filter on the large
    table's scan otherwise.
    """
    k = keys.select(F.col(key_col).alias("_rk")).distinct()
    return big.join(k, F.col(big_col) == F.col("_rk"), "left_semi")


FORWARD, BACKWARD, BOTH = 1, 2, 3


def _pairs(edges: DataFrame, src: str, dst: str) -> list[Column]:
    """``_lo, _hi, _open, _dir`` of an edge: its unordered pair, whether an end is null, its direction as a bit."""
    a, b = F.col(src), F.col(dst)
    return [F.least(a, b).alias("_lo"), F.greatest(a, b).alias("_hi"), (a.isNull() | b.isNull()).alias("_open"),
            F.when(a.isNull() | b.isNull(), F.lit(0)).when(a == b, F.lit(BOTH)).when(a < b, F.lit(FORWARD))
            .otherwise(F.lit(BACKWARD)).alias("_dir")]


def met_pairs(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """``_lo, _hi, _dir``: the directions in which each pair occurs, for later batches (see :func:`reciprocal_anti`)."""
    return edges.select(*_pairs(edges, src, dst)).filter(~F.col("_open")).groupBy("_lo", "_hi").agg(F.bit_or("_dir").alias("_dir"))


def reciprocal_anti(edges: DataFrame, src: str, dst: str, met: DataFrame | None = None) -> DataFrame:
    """Distinct edges whose reverse edge (any relation) does not exist.

    Both directions of a reciprocal pair disappear, and so do self-loops
    (an edge ``a→a`` is its own reverse); an edge with a null end has no reverse.

    One aggregation on the unordered pair: the directions met are or-ed, the
    distinct edges of the pair (its relations, in either direction) gathered, both
    map-side first; pairs met in one direction keep theirs.  ``met`` adds the
    directions that earlier batches have met (:func:`met_pairs`).
    """
    columns = edges.columns
    rows = edges.select(*_pairs(edges, src, dst), F.struct(*columns).alias("_edge"))
    if met is not None:
        none = F.lit(None).cast(rows.schema["_edge"].dataType)
        rows = rows.unionByName(met.select("_lo", "_hi", F.lit(False).alias("_open"), "_dir", none.alias("_edge")))
    pairs = rows.groupBy("_lo", "_hi", "_open").agg(F.bit_or("_dir").alias("_dir"), F.collect_set("_edge").alias("_edges"))
    return pairs.filter(F.col("_dir") != BOTH).select(F.explode("_edges").alias("_edge")) \
        .select(*[F.col(f"_edge.{c}").alias(c) for c in columns])


def canonical_edges(edges: DataFrame, src: str, dst: str, rel: str) -> DataFrame:
    """D9 ``canonical`` mode: one edge per unordered pair and relation.

    The kept direction is (least, greatest); self-loops stay once.
    """
    lo, hi = F.least(F.col(src), F.col(dst)), F.greatest(F.col(src), F.col(dst))
    return edges.select(lo.alias(src), hi.alias(dst), F.col(rel)).dropDuplicates()


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]], take: Sequence[str],
           how: str = "left", bounded: bool = False) -> DataFrame:
    """Add ``take`` columns of ``dim`` matched on ``on`` (child, dim) pairs.

    ``dim`` must have one row per key (a dict lookup); ``bounded=True``
    broadcasts it and is only for dimensions whose size does not grow with
    the data.
    """
    right = dim.select(*[F.col(d).alias(f"_k{i}") for i, (_, d) in enumerate(on)], *take)
    if bounded:
        right = F.broadcast(right)
    cond = None
    for i, (c, _) in enumerate(on):
        e = F.col(c) == F.col(f"_k{i}")
        cond = e if cond is None else cond & e
    out = df.join(right, cond, how)
    return out.drop(*[f"_k{i}" for i in range(len(on))])


def match_split(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]
                ) -> tuple[DataFrame, DataFrame]:
    """Incoming rows whose key exists (update set) and those that do not (insert set)."""
    ek = existing.select(*keys).dropDuplicates()
    return incoming.join(ek, list(keys), "left_semi"), incoming.join(ek, list(keys), "left_anti")


def new_only(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not yet in ``existing`` (insert-ignore)."""
    return incoming.join(existing.select(*keys).dropDuplicates(), list(keys), "left_anti")
