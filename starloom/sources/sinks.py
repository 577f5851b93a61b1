"""Table reads/writes and JSON outputs.

Tables are Parquet folders.  A dimension rewrite goes to a new version
folder (``…/v=<n>``); the current version is the highest one that has the
committer's ``_SUCCESS`` marker, so a job never overwrites the folder it is
reading, and a write that stops half-way leaves the previous version current.

Whether something is there is asked of the file system.  Any other failure
to read (no permission, a damaged file, a lost connection) is raised: it is
never taken for "nothing written yet".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.infer import infer_scalar
from ..session import compiled_methods
from .csv import csv_scan, split_malformed

JSON_TS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}


def table_scan(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """S3: read a stage table; the column list becomes the Parquet read schema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def bulk_append(df: DataFrame, path: str, columns: list[str] | None = None,
                partition_by: list[str] | None = None) -> None:
    """Append rows (the COPY / INSERT of the source system)."""
    w = (df.select(*columns) if columns else df).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def insert_ignore(incoming: DataFrame, existing: DataFrame | None, pk: list[str]) -> DataFrame:
    """``INSERT … ON CONFLICT (pk) DO NOTHING`` — the rows that would be inserted.

    Within ``incoming`` one row per key survives (smallest row, deterministic);
    keys already in ``existing`` are skipped.
    """
    rest = [c for c in incoming.columns if c not in pk]
    one = (incoming.groupBy(*pk).agg(F.min(F.struct(*rest)).alias("_r"))
           .select(*pk, *[F.col(f"_r.{c}").alias(c) for c in rest]))
    if existing is not None:
        one = one.join(existing.select(*pk).distinct(), pk, "left_anti")
    return one.select(*incoming.columns)


def write_quarantine(rejects: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write rejects (``entity, reason, row`` …) as gzipped JSON lines, one folder per entity.

    Give each writer its own ``path`` (e.g. per step and batch): Hadoop's
    output committer keeps one job directory per path, so two concurrent
    jobs must not target the same folder.
    """
    rejects.write.mode(mode).option("compression", "gzip").partitionBy("entity").json(path)


def to_json_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One JSON object per row, timestamps as ISO ``yyyy-MM-ddTHH:mm:ss``."""
    cols = columns or df.columns
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols]), JSON_TS).alias("json"))


def keyed_last_wins(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per ``key``, the last in source order (``order_col`` ascending).

    ``max_by`` is a partial aggregate, so repeated keys combine map-side.
    The result is ``key, json`` with the whole row as a JSON object.
    """
    rest = [c for c in df.columns if c != order_col]
    return df.groupBy(key).agg(F.max_by(F.to_json(F.struct(*[F.col(c) for c in rest])),
                                        F.col(order_col)).alias("json"))


def typed_json_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each text cell typed by the P8 rule, the row rendered as a JSON object."""
    cols = columns or df.columns
    return df.select(F.to_json(F.struct(*[infer_scalar(c).alias(c) for c in cols])).alias("json"))


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; raises if the file system cannot tell."""
    p, fs = _path(spark, path)
    return fs.exists(p)


def csv_to_json(spark: SparkSession, csv_path: str, json_path: str, key: str | None = None, compression: str = "none") -> None:
    """S10/S11 end to end: a CSV path to JSON lines.

    With ``key`` one object per key, the last row winning, of several files the one
    whose name comes last; without it every row, its cells typed by the P8 rule.
    Malformed rows have no JSON; a blank cell is the empty text.
    """
    rows, _ = split_malformed(csv_scan(spark, csv_path, order="_row_order"), "csv")
    rows = rows.na.fill("")
    if key is None:
        out = typed_json_rows(rows.drop("_row_order"))
    else:
        out = keyed_last_wins(rows, key, "_row_order").select("json")
    with compiled_methods(spark):  # a typed cell is a wide expression
        out.write.mode("overwrite").option("compression", compression).text(json_path)


def current_version(spark: SparkSession, table_root: str) -> int:
    """The highest completely written version of a table (0 before the first)."""
    p, fs = _path(spark, table_root)
    if not fs.exists(p):
        return 0
    done = [0]
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("v=") and exists(spark, f"{table_root}/{name}/_SUCCESS"):
            done.append(int(name[2:]))
    return max(done)


def read_version(spark: SparkSession, table_root: str) -> tuple[DataFrame | None, int]:
    """The current version of a table and its number (None and 0 before the first)."""
    v = current_version(spark, table_root)
    return (spark.read.parquet(f"{table_root}/v={v}") if v else None), v


def write_version(df: DataFrame, table_root: str, version: int) -> str:
    """Write ``df`` to ``table_root/v=<version>``; it becomes current with its commit marker."""
    path = f"{table_root}/v={version}"
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
    return path


def write_batch_part(df: DataFrame, table_root: str, batch_id: int, partition_by: list[str] | None = None) -> str:
    """Insert-only tables: this batch's new rows in ``table_root/batch=<id>``.

    Nothing already stored is rewritten; re-running the same batch replaces
    only its own folder.  The folder counts once its commit marker is there.
    """
    path = f"{table_root}/batch={batch_id}"
    w = df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return path


def folders(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Paths directly below ``root`` whose name starts with ``prefix``, sorted (none if ``root`` is not there)."""
    p, fs = _path(spark, root)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(p) if st.getPath().getName().startswith(prefix))


def committed_parts(spark: SparkSession, table_root: str) -> list[str]:
    """The batch folders of a table that have their commit marker."""
    return [part for part in folders(spark, table_root, "batch=") if exists(spark, f"{part}/_SUCCESS")]


def read_table(spark: SparkSession, table_root: str, columns: list[str] | None = None) -> DataFrame | None:
    """The committed batch folders of an insert-only table (None before the first commit).

    A folder without the committer's marker belongs to a write that is still going
    on or stopped half-way: its rows are in no result.
    """
    parts = committed_parts(spark, table_root)
    if not parts:
        return None
    df = spark.read.option("basePath", table_root).parquet(*parts)
    return df.select(*columns) if columns else df
