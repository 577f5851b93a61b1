"""Key rules: unique keys with quarantine (K1), foreign keys (J10/K3) and
dense surrogate keys (L1).

All of these avoid a single-partition window and hold under a hot key:
winners come from a partial (map-side) aggregate, key numbering from a
range partitioning whose per-partition counts are tiny.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .validate import DUPLICATE_KEY, MISSING_KEY, REASON


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def dedupe_on_key(df: DataFrame, keys: Sequence[str],
                  prefer: Sequence[Column] | None = None,
                  reason_col: str = REASON) -> tuple[DataFrame, DataFrame]:
    """K1: one row per key; the others are returned with reason ``duplicate key``.

    ``prefer`` lists expressions whose *smallest* value wins (see
    :func:`latest_first` for "newest wins").  Remaining ties go to the
    smallest full row, so the choice is deterministic.  Exact copies of a row
    collapse into one, as after a ``DISTINCT``.

    Keys met once, nearly all of them, only take part in a count per key: the
    repeated keys are written first, so that Spark knows how few they are and
    broadcasts them; the rows, texts included, then pass the join without a
    shuffle and are neither sorted nor grouped.  ``df`` is read several times
    and should be a stored table.  Rows of
    repeated keys are ranked by a ``min`` aggregate, so a key that holds a
    third of the rows is combined map-side before the shuffle; its other rows
    are told from the winner by an aggregate over whole rows, which deals them
    over all tasks.
    """
    payload = [c for c in df.columns if c not in keys]
    order = list(prefer or [])
    names = [f"_dup{i}" for i in range(len(keys))]

    def same(prefix_names):
        cond = F.lit(True)
        for k, n in zip(keys, prefix_names):
            cond = cond & F.col(k).eqNullSafe(F.col(n))
        return cond

    repeated = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
                           .select(*[F.col(k).alias(n) for k, n in zip(keys, names)]))
    once = df.join(repeated, same(names), "left_anti")
    rank = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                    *[F.col(c) for c in payload])
    ranked = df.join(repeated, same(names), "left_semi").withColumn("_rank", rank)
    winners = ranked.groupBy(*keys).agg(F.min("_rank").alias("_best"))
    kept = once.select(*df.columns).unionByName(
        winners.select(*_cols(keys), *[F.col(f"_best.{c}").alias(c) for c in payload]).select(*df.columns))
    # The other distinct rows of repeated keys: rows and winners are grouped as whole
    # rows, so the rows of a hot key spread by all their columns and nothing is joined.
    won = winners.select(*_cols(keys), *[F.col(f"_best.{c}").alias(c) for c in payload], F.lit(1).alias("_won"))
    dropped = (ranked.select(*df.columns, F.lit(0).alias("_won"))
               .unionByName(won.select(*df.columns, "_won"))
               .groupBy(*df.columns).agg(F.max("_won").alias("_won"))
               .filter(F.col("_won") == 0).drop("_won")
               .withColumn(reason_col, F.lit(DUPLICATE_KEY)))
    return kept, dropped


def not_null_key(df: DataFrame, keys: Sequence[str], reason_col: str = REASON) -> tuple[DataFrame, DataFrame]:
    """K2: rows whose key columns are all there, and the others with reason ``missing key``."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.filter(~missing), df.filter(missing).withColumn(reason_col, F.lit(MISSING_KEY))


def latest_first(ts: str | Column) -> Column:
    """Preference value for :func:`dedupe_on_key`: newest timestamp wins, null last."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.lit(0) - F.unix_micros(c.cast("timestamp")), F.lit(2 ** 62))


def fk_split(df: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]],
             reason: str, reason_col: str = REASON) -> tuple[DataFrame, DataFrame]:
    """Rows whose key exists in ``parent`` and orphans with a reason.

    ``on`` pairs (child column, parent column).  Both sides are semi/anti
    joins on the parent's distinct keys, so the parent contributes one row
    per key whatever its size.
    """
    pkeys = parent.select(*[F.col(p).alias(c) for c, p in on]).dropDuplicates()
    child_cols = [c for c, _ in on]
    ok = df.join(pkeys, child_cols, "left_semi")
    orphans = df.join(pkeys, child_cols, "left_anti").withColumn(reason_col, F.lit(reason))
    return ok, orphans


def max_key(dim: DataFrame | None, key_col: str) -> int:
    """Largest existing surrogate key (0 for a missing dimension or one of reserved members only).

    One scalar aggregate; nothing but the number reaches the driver.
    """
    if dim is None:
        return 0
    v = dim.agg(F.max(key_col).alias("m")).first()["m"]
    return max(int(v), 0) if v is not None else 0


def assign_surrogate_keys(df: DataFrame, order_cols: Sequence[str], key_col: str,
                          start_after: int = 0, num_partitions: int | None = None) -> DataFrame:
    """L1: dense keys ``start_after + 1 …`` in the order of ``order_cols``.

    Steps: range-partition on the order, sort inside partitions, tag each
    row with its partition and position; a written copy pins that
    layout so a re-run task cannot see different range bounds.  The counts
    per partition (one row per partition, a bounded side) give each
    partition its offset.  No global single-partition window is used.

    ``order_cols`` should identify rows (natural key); ties are numbered in
    the written order.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *_cols(order_cols))
              .sortWithinPartitions(*_cols(order_cols))
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    ranged = materialize(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first"))
    # At most n rows: a prefix sum over the partition counts.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    keyed = ranged.join(F.broadcast(offsets.select("_pid", "_first", "_before")), "_pid")
    key = F.lit(start_after) + F.col("_before") + (F.col("_pos") - F.col("_first")) + F.lit(1)
    return keyed.withColumn(key_col, key.cast("long")).drop("_pid", "_pos", "_first", "_before")
