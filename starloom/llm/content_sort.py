"""Operator 3: exact dedup by a content sort.

Rows are range-partitioned on their normalised bytes by sampled splitters and
sorted externally, so equal texts become neighbours; a scan compares each row
in full with the neighbour before it and the smallest id of a run stays.

The sort key is (first ``HEAD`` characters of the normalised text, SHA-256 of
the whole normalised text, id).  The digest stands for the bytes after the
head, which keeps sampled splitters and comparisons short however long texts
are; it only *places* rows, equality is decided by comparing whole texts.
The id is the last part of the key, so splitters also cut through one text
that holds a third of all rows; the pieces of such a run, at most two per
partition, are stitched afterwards.

Defined cases: a null text is the empty text; null ids count as larger than
any id (``keep_id`` is null only if every id of the group is null); of repeated
rows exactly one stays; an empty table gives an empty result; extra columns
are ignored by :func:`content_sort_dedup` and kept by :func:`keep_first`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import WHITE, prepare, text_column, written

HEAD = 64
_WHITE = re.compile(r"[\x20\x09-\x0D]+")

_MARK = T.StructType([
    T.StructField("_pid", T.IntegerType()), T.StructField("_run", T.LongType()),
    T.StructField("_n", T.LongType()), T.StructField("_lead", T.LongType()),
    T.StructField("_first", T.BooleanType()), T.StructField("_edge", T.StringType())])


def _sorted_rows(docs: DataFrame, id_col: str, text_col: str, payload: list) -> DataFrame:
    text = text_column(text_col)
    norm = F.regexp_replace(text, WHITE, " ")
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"), norm.alias("_norm"), *payload)
    rows = rows.select("_id", "_text", F.substring("_norm", 1, HEAD).alias("_head"),
                       F.sha2(F.col("_norm").cast("binary"), 256).alias("_sha"),
                       *[c for c in rows.columns if c not in ("_id", "_text", "_norm")])
    key = [F.col("_head"), F.col("_sha"), F.col("_id").asc_nulls_last()]
    return rows.repartitionByRange(*key).sortWithinPartitions(*key)


class _Run:
    """One run of equal texts inside a partition."""

    __slots__ = ("no", "norm", "ids", "row", "text")

    def __init__(self, no: int, text: str):
        self.no, self.text, self.norm, self.ids, self.row = no, text, None, [], None

    def same(self, other: str) -> bool:
        if self.norm is None:
            self.norm = _WHITE.sub(" ", self.text)
        return self.norm == other


def _scan(batches: Iterator[pa.RecordBatch], carry: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Number the runs of a sorted partition.

    Without ``carry`` every row leaves with its run; with it only the first
    row of each run leaves, with the carried columns.
    """
    pid, count, digest = TaskContext.get().partitionId(), 0, None
    group: list[_Run] = []  # the runs of the present digest: one, unless digests collide
    first_group = True
    out: list[tuple] = []
    kept: list[pa.RecordBatch] = []

    def close(last: bool):
        nonlocal first_group, group
        for run in group:
            edge = _WHITE.sub(" ", run.text) if first_group or last else None
            lead = run.ids[0]
            marks = [(pid, run.no, len(run.ids), lead, k == 0, edge if k == 0 else None)
                     for k in range(1 if carry else len(run.ids))]
            if carry:
                kept.append((run.row, marks[0]))
            else:
                out.extend((i, digest, *m) for i, m in zip(run.ids, marks))
        first_group, group = first_group and not group, []

    def flush():
        nonlocal out, kept
        if carry and kept:
            data = pa.Table.from_batches([r for r, _ in kept])
            cols = [data.column(c).combine_chunks() for c in carry]
            cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols]
            marks = list(zip(*[m for _, m in kept]))
            cols += [pa.array(v, type=f.type) for v, f in zip(marks, list(schema)[len(carry):])]
            kept = []
            yield pa.RecordBatch.from_arrays(cols, schema=schema)
        elif out:
            cols = [pa.array(v, type=f.type) for v, f in zip(zip(*out), schema)]
            out = []
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    for b in batches:
        ids, shas, texts = b.column("_id").to_pylist(), b.column("_sha").to_pylist(), b.column("_text")
        for k, (i, sha) in enumerate(zip(ids, shas)):
            if sha != digest:
                close(last=False)
                digest = sha
            text = texts[k].as_py()
            run = None
            if group:
                norm = _WHITE.sub(" ", text)
                run = next((r for r in group if r.same(norm)), None)
            if run is None:
                run = _Run(count, text)
                count += 1
                if carry:
                    run.row = b.slice(k, 1)
                group.append(run)
            run.ids.append(i)
        yield from flush()
    close(last=True)
    yield from flush()


def _stitched(marked: DataFrame) -> DataFrame:
    """Runs of one text that lie in several partitions: their common size, lead and winner.

    Only the first and last runs of a partition can continue elsewhere, so
    this reads two rows per partition.
    """
    edges = marked.where(F.col("_edge").isNotNull())
    rank = F.struct(F.col("_lead").isNull(), "_lead", "_pid", "_run")
    groups = edges.groupBy("_edge").agg(
        F.count(F.lit(1)).alias("_k"), F.sum("_n").alias("_all"), F.min("_lead").alias("_min"),
        F.min(rank).alias("_win"), F.collect_list(F.struct("_pid", "_run")).alias("_parts"))
    return groups.where("_k > 1").select(
        F.explode("_parts").alias("_p"), "_all", "_min", F.col("_win._pid").alias("_wp"), F.col("_win._run").alias("_wr")
    ).select(F.col("_p._pid").alias("_pid"), F.col("_p._run").alias("_run"), "_all", "_min", "_wp", "_wr")


def _with_groups(marked: DataFrame) -> DataFrame:
    # two rows per partition at most, without texts: the broadcast is bounded by the partition count
    both = marked.join(F.broadcast(_stitched(marked)), ["_pid", "_run"], "left")
    wins = F.col("_wp").isNull() | ((F.col("_wp") == F.col("_pid")) & (F.col("_wr") == F.col("_run")))
    return both.withColumn("_keep", F.col("_first") & wins)


def content_sort_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    prepare(spark)
    rows = _sorted_rows(docs, id_col, text_col, [])
    out = T.StructType([T.StructField("_id", T.LongType()), T.StructField("_sha", T.StringType()), *_MARK.fields])
    schema = _arrow(out)
    marked = written(rows.mapInArrow(lambda it: _scan(it, [], schema), out), "content-sort")
    return _with_groups(marked).select(
        F.col("_id").alias(id_col), F.when(F.col("_wp").isNull(), F.col("_lead")).otherwise(F.col("_min")).alias("keep_id"),
        F.coalesce("_all", "_n").alias("group_size"), F.col("_keep").alias("kept"), F.col("_sha").alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all columns of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    names = [f"_c{k}" for k in range(len(docs.columns))]
    # the text itself travels once, as _text; a null text is told by its flag
    payload = [(F.col(f"`{c}`").isNull() if c == text_col else F.col(f"`{c}`")).alias(n)
               for n, c in zip(names, docs.columns)]
    rows = _sorted_rows(docs, id_col, text_col, payload)
    carry = ["_text", *names]
    fields = [T.StructField("_text", T.StringType()), *[rows.schema[n] for n in names]]
    out = T.StructType([*[T.StructField(f.name, f.dataType) for f in fields], *_MARK.fields])
    schema = _arrow(out)
    marked = written(rows.mapInArrow(lambda it: _scan(it, carry, schema), out), "content-sort-rows")
    kept = _with_groups(marked).where("_keep")
    return kept.select(*[
        (F.when(~F.col(n), F.col("_text")).cast(docs.schema[c].dataType) if c == text_col else F.col(n)).alias(c)
        for n, c in zip(names, docs.columns)])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)
