"""Operator 12: whitening of embeddings, fitted on distinct vectors weighted by how often they occur.

Components are put on an integer grid (``floor(scale * c) + offset``), so equal
vectors are equal integers.  Identical vectors are grouped once; each group has
its count (or one) as fit weight.  Tasks add up exact weighted sums, then the
products of centred rows: ``n * x - S`` is taken in integers and divided by
``n``, so centring loses nothing, and a weighted matrix product sums a batch.
Only sums (a number a dimension) and the covariance (a number a pair of
dimensions) reach the driver, which takes its eigenvectors.  Every distinct
vector is whitened once, written, and joined back to the rows by the SHA-256
of its integers.  A vector that holds more than a thousandth of the rows is
dealt over several tasks in that join; there are at most ``HOT_SHARE`` of those.

Defined cases: a null or empty vector, and one with a null or non-finite
component, takes no part; so do all other columns.  Vectors of several lengths
and components beyond ``MAX_COMPONENT`` (where the grid is no longer exact) are
errors that say so.  Repeated rows and null ids are rows like others.
Components whose eigenvalue is below ``RANK_TOLERANCE`` of the largest carry no
variance and are left out, so equal vectors only, one row or an empty table
give no rows.  ``deviation`` is a decimal, as it outgrows a long on large tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import prepare, written

SCALE, OFFSET = 64, 1_000_000
HOT_SHARE = 1000
RANK_TOLERANCE = 1e-10
MAX_COMPONENT = float(2 ** 45)
EXACT = 2 ** 62

_OUT = ("id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")


def gridded(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, x``: the integer vectors of the rows that take part."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    fine = vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("v")).where(F.coalesce(fine, F.lit(False)))
    x = F.transform("v", lambda c: F.when(F.abs(c) <= MAX_COMPONENT, F.floor(c * F.lit(float(SCALE))) + F.lit(OFFSET))
                    .otherwise(F.raise_error(F.lit(f"a component beyond {MAX_COMPONENT:.0f} has no exact grid value")).cast("long")))
    return rows.select("id", x.alias("x"))


def _key(x: str) -> Column:
    return F.unhex(F.sha2(F.concat_ws(",", F.col(x).cast("array<string>")).cast("binary"), 256))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("weight")).to_numpy()


def _of(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def _weighted_sum(x: np.ndarray, w: np.ndarray) -> list[int]:
    if int(w.sum()) * max(int(np.abs(x).max(initial=0)), 1) < EXACT:
        return [int(s) for s in w @ x]
    return [sum(int(a) * int(b) for a, b in zip(w, column)) for column in x.T]


def exact_sums(groups: DataFrame, width: int) -> list[int]:
    """S: the weighted sum of each dimension, exact."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for b in batches:
            total = [a + s for a, s in zip(total, _weighted_sum(_matrix(_of(b, "x"), width), _weights(b)))]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()),
                                          pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["i", "s"])
    rows = groups.select("x", "weight").mapInArrow(partial, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    by = {r.i: int(r.s) for r in rows}
    return [by.get(i, 0) for i in range(width)]


class Centre:
    """Exact centring by the sums: ``numerators`` is ``n * x - S``, in integers."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.near = [round(s / n) for s in sums]               # integers close to the means keep products small
        self.rest = [s - n * m for s, m in zip(sums, self.near)]

    def numerators(self, x: np.ndarray) -> np.ndarray:
        y = x - np.array(self.near, dtype=np.int64)
        if self.n * (int(np.abs(y).max(initial=0)) + 1) < EXACT:
            return y * np.int64(self.n) - np.array(self.rest, dtype=np.int64)
        return y.astype(object) * self.n - np.array(self.rest, dtype=object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[Decimal]:
        z = self.numerators(x)
        most = int(np.abs(z).max(initial=0))
        if z.dtype != object and most * most * max(x.shape[1], 1) < EXACT:
            return [Decimal(int(d)) for d in (z * z).sum(axis=1)]
        return [Decimal(sum(int(v) * int(v) for v in row)) for row in z]


def _moments(groups: DataFrame, column: str, width: int, values) -> np.ndarray:
    """The sum over weighted rows of the outer products of ``values(matrix)``: one product a batch, one matrix a task."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            v = values(_matrix(_of(b, column), width))
            total += (v * _weights(b)[:, None].astype(np.float64)).T @ v
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])
    out = np.zeros((width, width))
    for r in groups.select(column, "weight").mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


def _means(groups: DataFrame, column: str, width: int, n: int) -> np.ndarray:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            total += _weights(b).astype(np.float64) @ _matrix(_of(b, column), width)
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total)], names=["i", "v"])
    out = np.zeros(width)
    for r in groups.select(column, "weight").mapInArrow(partial, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r.i] = r.v / n
    return out


def principal_axes(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and their unit eigenvectors as columns, those that carry variance."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = (values > max(values[0], 0.0) * RANK_TOLERANCE)[:most].sum() if len(values) else 0
    vectors = vectors[:, :keep]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)])
    return values[:keep], vectors * signs


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32,
           weights: str = "counts") -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` a row and component.

    ``weights="counts"`` fits on all vectors, ``"one"`` on the distinct ones.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"weights must be counts or one, not {weights!r}")
    spark = df.sparkSession
    prepare(spark)
    rows = gridded(df, id_col, vector_col)
    grouped = rows.groupBy("x").agg(F.count(F.lit(1)).alias("rows"))
    groups = written(grouped.select(_key("x").alias("key"), "x", "rows",
                                    (F.col("rows") if weights == "counts" else F.lit(1).cast("long")).alias("weight")), "whitening-groups")
    shape = groups.agg(F.sum("rows").alias("rows"), F.sum("weight").alias("n"), F.min(F.size("x")).alias("lo"),
                       F.max(F.size("x")).alias("hi")).first()
    if not shape.rows:
        return spark.createDataFrame([], _OUT)
    if shape.lo != shape.hi:
        raise ValueError(f"vectors have from {shape.lo} to {shape.hi} components; one length is needed")
    width, n = shape.hi, int(shape.n)
    centre = Centre(n, exact_sums(groups, width))
    covariance = _moments(groups, "x", width, centre.centred) / n
    values, axes = principal_axes(covariance, components)
    k = len(values)
    if not k:
        return spark.createDataFrame([], _OUT)
    scaled = axes / np.sqrt(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(_of(b, "x"), width)
            out = centre.centred(x) @ scaled
            lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, k, dtype=np.int32), out.reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [_of(b, "key"), _of(b, "rows"), _of(b, "weight"), pa.array(centre.deviations(x), pa.decimal128(38, 0)), lists],
                names=["key", "rows", "weight", "deviation", "white"])
    distinct = written(groups.mapInArrow(project, "key binary, rows long, weight long, deviation decimal(38,0), white array<double>"),
                       "whitening-distinct")
    mean = _means(distinct, "white", k, n)
    error = float(np.abs(_moments(distinct, "white", k, lambda v: v - mean) / n - np.eye(k)).max())
    joined = _join_back(rows.select("id", _key("x").alias("key")), distinct, int(shape.rows))
    explained = F.array(*[F.lit(float(e)) for e in values / np.trace(covariance)])
    long = joined.select("id", "deviation", F.posexplode("white").alias("at", "whitened"))
    return long.select("id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                       explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))


def _join_back(rows: DataFrame, distinct: DataFrame, total: int) -> DataFrame:
    """Rows with their group's columns; a group of over ``total / HOT_SHARE`` rows is dealt over several tasks.

    The counts of all groups add up to ``total``, so fewer than ``HOT_SHARE`` are that
    large, whatever the table: that list is broadcast.
    """
    deals = F.ceil(F.col("rows") * F.lit(float(HOT_SHARE)) / F.lit(float(total))).cast("int")
    hot = distinct.where(F.col("rows") * F.lit(HOT_SHARE) > F.lit(total)).select(F.col("key").alias("hot"), deals.alias("deals"))
    dealt = rows.join(F.broadcast(hot), F.col("key") == F.col("hot"), "left").select(
        "id", "key", F.when(F.col("deals").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(F.col("id")), F.col("deals"))).cast("int").alias("deal"))
    copies = F.sequence(F.lit(0), F.when(F.col("rows") * F.lit(HOT_SHARE) > F.lit(total), deals - 1).otherwise(F.lit(0)))
    each = distinct.select("key", "deviation", "white", F.explode(copies).alias("deal"))
    return dealt.join(each, ["key", "deal"]).select("id", "deviation", "white")
