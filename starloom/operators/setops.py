"""Set operations of the loaders (U1–U3, A1/A2/A6) and paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """A1: ``SELECT DISTINCT *`` (hash aggregate with map-side combine)."""
    return df.distinct()


def distinct_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values of a column subset."""
    return df.select(*cols).distinct()


def except_keys(keys: DataFrame, known: DataFrame, key: str, known_key: str) -> DataFrame:
    """``SELECT DISTINCT k … EXCEPT SELECT known_key …`` as a distinct anti join."""
    ref = keys.select(F.col(key).alias(key)).distinct()
    kn = known.select(F.col(known_key).alias(key)).distinct()
    return ref.join(kn, key, "left_anti")


def append(base: DataFrame, extra: DataFrame) -> DataFrame:
    """``INSERT`` of more rows, by column name."""
    return base.unionByName(extra)


def key_union(a: DataFrame, a_col: str, b: DataFrame, b_col: str, name: str) -> DataFrame:
    """Distinct union of two key columns."""
    return a.select(F.col(a_col).alias(name)).union(b.select(F.col(b_col).alias(name))).distinct()


def page(df: DataFrame, order: Sequence[Column | str], n: int, k: int = 0) -> DataFrame:
    """``ORDER BY … LIMIT n OFFSET k`` with a stated order (never unordered)."""
    return df.orderBy(*order).offset(k).limit(n)
