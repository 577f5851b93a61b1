"""Bridge and auxiliary loaders: product–category bridge (L6) and related
products (L8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import restrict_to_keys
from .validate import REASON

# Reasons for rows whose natural key has no dimension member.
UNKNOWN_PRODUCT = "unknown product"
UNKNOWN_CATEGORY = "unknown category"
UNKNOWN_RELATED = "unknown related product"


def current_products(product_dim: DataFrame) -> DataFrame:
    """(source key → product key) for current versions only (D11); one row per key."""
    return product_dim.filter(F.col("is_current")).select("product_source_key", "product_key")


def load_bridge(pairs: DataFrame, product_dim: DataFrame, category_dim: DataFrame,
                existing: DataFrame | None = None, src: str = "pc_product_source_key",
                cat: str = "pc_category") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(source key, category name) → (product_key, category_key), skipping pairs present.

    Returns (bridge, added pairs, quarantined rows with a reason).
    """
    prods = restrict_to_keys(current_products(product_dim), "product_source_key", pairs, src) \
        .withColumnRenamed("product_source_key", "_src")
    cats = restrict_to_keys(category_dim, "product_category", pairs, cat) \
        .select(F.col("product_category").alias("_cat"), "category_key")
    j = (pairs.select(F.col(src).alias("src"), F.col(cat).alias("category")).distinct()
         .join(prods, F.col("src") == F.col("_src"), "left")
         .join(cats, F.col("category") == F.col("_cat"), "left"))
    j = j.withColumn(REASON, F.when(F.col("product_key").isNull(), F.lit(UNKNOWN_PRODUCT))
                     .when(F.col("category_key").isNull(), F.lit(UNKNOWN_CATEGORY)))
    bad = j.filter(F.col(REASON).isNotNull()).select("src", "category", REASON)
    good = j.filter(F.col(REASON).isNull()).select("product_key", "category_key").distinct()
    if existing is not None:
        good = good.join(existing.select("product_key", "category_key"), ["product_key", "category_key"],
                         "left_anti")
    bridge = good if existing is None else existing.select("product_key", "category_key").unionByName(good)
    return bridge, good, bad


def load_related(edges: DataFrame, product_dim: DataFrame, existing: DataFrame | None = None,
                 src: str = "rl_product_source_key", dst: str = "rl_related_product_source_key",
                 rel: str = "rl_relation") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges → (primary, secondary) product keys; one relation per pair.

    The primary key of the table is the pair, so a pair seen with several
    relations keeps the smallest relation name (D10).  Pairs already present
    are skipped (insert-ignore).  Returns (table, added, quarantined).
    """
    ends = edges.select(F.col(src).alias("_k")).unionByName(edges.select(F.col(dst).alias("_k")))
    prods = restrict_to_keys(current_products(product_dim), "product_source_key", ends, "_k")
    p1 = prods.select(F.col("product_source_key").alias("_s1"), F.col("product_key").alias("primary_product_key"))
    p2 = prods.select(F.col("product_source_key").alias("_s2"),
                      F.col("product_key").alias("secondary_product_key"))
    j = (edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"), F.col(rel).alias("relation"))
         .join(p1, F.col("src") == F.col("_s1"), "left")
         .join(p2, F.col("dst") == F.col("_s2"), "left"))
    j = j.withColumn(REASON, F.when(F.col("primary_product_key").isNull(), F.lit(UNKNOWN_PRODUCT))
                     .when(F.col("secondary_product_key").isNull(), F.lit(UNKNOWN_RELATED)))
    bad = j.filter(F.col(REASON).isNotNull()).select("src", "dst", "relation", REASON)
    good = (j.filter(F.col(REASON).isNull())
            .groupBy("primary_product_key", "secondary_product_key")
            .agg(F.min("relation").alias("relation")))
    pk = ["primary_product_key", "secondary_product_key"]
    if existing is not None:
        good = good.join(existing.select(*pk), pk, "left_anti")
    cols = [*pk, "relation"]
    table = good if existing is None else existing.select(*cols).unionByName(good)
    return table, good, bad
