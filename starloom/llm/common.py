"""Helpers shared by the training-data operators: written intermediates and packed arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import ensure_checkpoint_dir, scratch_path, ship_package

WHITE = r"[\x20\x09-\x0D]+"
U64 = np.uint64


def prepare(spark: SparkSession) -> None:
    """Name the shared checkpoint folder and make this package importable in the workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_column(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def batch(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (two xor-shift multiplies)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted uint64 values as differences, byte plane by byte plane, compressed."""
    steps = np.diff(values, prepend=U64(0))
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    steps = np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(U64)
    return np.cumsum(steps, dtype=U64)


def pack(values: np.ndarray) -> bytes:
    """Any array as compressed byte planes; :func:`unpack` needs its dtype."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(blob: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(dtype.itemsize, -1).T).reshape(-1).view(dtype)


def bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where sorted uint64 ``keys`` fall into ``buckets`` equal ranges: ``buckets + 1`` offsets."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=U64)
    return np.concatenate([[0], np.searchsorted(keys, edges, side="left"), [len(keys)]])
