"""Late-arriving dimension members.

Keys referenced by child rows (reviews, categories, either end of a
relation) but absent from the product staging table get a placeholder
product row, so every foreign key resolves; the next product snapshot's
SCD2 merge replaces the placeholder attributes with real ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import PRODUCT_DEFAULTS
from .setops import except_keys

S2_PRODUCT_COLUMNS = ["p_product_metadata_id", "p_product_source_key", "p_sales_rank_category",
                      "p_sales_rank", "p_image_url", "p_title", "p_description", "p_price", "p_brand"]


def missing_keys(referenced: Sequence[tuple[DataFrame, str]], products: DataFrame,
                 key: str = "p_product_source_key") -> DataFrame:
    """U1 over several referencing columns: distinct keys not in ``products``."""
    refs = None
    for df, c in referenced:
        part = df.select(F.col(c).alias("_key"))
        refs = part if refs is None else refs.unionByName(part)
    return except_keys(refs, products, "_key", key).withColumnRenamed("_key", key)


def placeholder_products(keys: DataFrame, key: str = "p_product_source_key") -> DataFrame:
    """Placeholder stage-2 product rows for ``keys`` (the documented defaults, D13)."""
    d = PRODUCT_DEFAULTS
    return keys.select(
        F.lit(d["metadata_id"]).alias("p_product_metadata_id"),
        F.col(key).alias("p_product_source_key"),
        F.lit(d["sales_rank_category"]).alias("p_sales_rank_category"),
        F.lit(d["sales_rank"]).cast("int").alias("p_sales_rank"),
        F.lit(d["image_url"]).alias("p_image_url"),
        F.lit(d["title"]).alias("p_title"),
        F.lit(d["description"]).alias("p_description"),
        F.lit(d["price"]).cast("double").alias("p_price"),
        F.lit(d["brand"]).alias("p_brand"))


def add_late_arriving(products: DataFrame, referenced: Sequence[tuple[DataFrame, str]],
                      known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(products with placeholders appended, the placeholders alone).

    ``known`` holds the source keys of products loaded by earlier batches
    (column ``p_product_source_key``): they need no placeholder, and none may
    replace them.
    """
    have = products.select("p_product_source_key")
    if known is not None:
        have = have.unionByName(known.select("p_product_source_key"))
    ph = placeholder_products(missing_keys(referenced, have))
    return products.select(*S2_PRODUCT_COLUMNS).unionByName(ph), ph
