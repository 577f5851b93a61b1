"""Keys that earlier batches have met, kept in a stored index by hash bucket.

Stage 2 enforces its keys over all batches, not only within one: a primary key
taken by an earlier batch stays taken, and an edge whose reverse came earlier
is reciprocal.  Reading the whole of stage 2 for that would make a batch cost
what the history costs, so each batch leaves a narrow part
``<root>/by=<buckets>/batch=<id>/bucket=<b>`` with what it met, and a later
batch reads the buckets that its own keys fall into, and of those only the
parts of batches that completed.  A batch that failed has met nothing: its
rows can come again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources import sinks as Sk
from .keys import dedupe_on_key
from .validate import DUPLICATE_KEY, REASON

BUCKETS = 16
DIGEST = "row_digest"
DIGEST_BYTES = 16


def row_digest(columns: Sequence[str]) -> Column:
    """The first 16 bytes of SHA-256 over a row's values; each value is written with its length, so none runs into the next.

    It tells rows of one key apart: that two agree by chance is one in 2^128.
    """
    def cell(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.unhex(F.substring(F.sha2(F.concat(*[cell(c) for c in columns]).cast("binary"), 256), 1, 2 * DIGEST_BYTES))


class KeyIndex:
    """A stored table of key columns (and more), in hash buckets of ``keys``."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.keys = spark, list(keys)
        # an index keeps the number of buckets it began with
        there = Sk.folders(spark, root, "by=")
        self.buckets = int(there[0].rsplit("=", 1)[1]) if there else buckets
        self.root = f"{root}/by={self.buckets}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, incoming: DataFrame) -> list[int]:
        """The buckets that a batch's keys fall into: at most ``buckets`` numbers."""
        return sorted(r[0] for r in incoming.select(self.bucket().alias("b")).distinct().collect())

    def read(self, batches: Iterable[int], buckets: Sequence[int]) -> DataFrame | None:
        """What the given batches left in the given buckets (None if nothing)."""
        rows = Sk.read_table(self.spark, self.root)
        batches = list(batches)
        if rows is None or not batches or not buckets:
            return None
        return rows.filter(F.col("batch").isin(batches) & F.col("bucket").isin(list(buckets))).drop("bucket")

    def write(self, rows: DataFrame, batch_id: int) -> str:
        """This batch's part, one file a bucket; a re-run of the batch replaces it."""
        dealt = rows.withColumn("bucket", self.bucket()).repartition(F.col("bucket"))
        return Sk.write_batch_part(dealt, self.root, batch_id, ["bucket"])


def dedupe_across(df: DataFrame, keys: Sequence[str], seen: DataFrame | None,
                  prefer: Sequence[Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """K1 over batches: (rows whose key is new, rejects with reason ``duplicate key``).

    ``seen`` has the keys of earlier batches (each once) and the digest of the row
    that took them.  That row met again is neither kept nor rejected; any other row
    of its key is rejected, whatever its preference: the key is taken.  Keys not
    taken go through :func:`~starloom.operators.keys.dedupe_on_key`.

    The rows are joined with the taken keys once; what is left of them (in a batch
    that repeats earlier rows, little) is kept for the steps that follow.
    """
    if seen is None:
        return dedupe_on_key(df, keys, prefer)
    taken = seen.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)], F.substring(DIGEST, 1, DIGEST_BYTES).alias("_sd"))  # older indexes hold all 32 bytes
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_s{i}"))
    met = df.join(taken, same, "left")  # the digest is taken after the join, so that it is not shuffled with the row
    left = materialize(met.filter(F.col("_sd").isNull() | (F.col("_sd") != row_digest(df.columns)))
                       .select(*df.columns, F.col("_sd").isNull().alias("_free")))
    kept, dropped = dedupe_on_key(left.filter("_free").drop("_free"), keys, prefer)
    # grouped as whole rows: the rows of a hot key spread by all their columns
    conflicts = left.filter("NOT _free").drop("_free").dropDuplicates().withColumn(REASON, F.lit(DUPLICATE_KEY))
    return kept, dropped.unionByName(conflicts)
