"""Validation rules with a reason for every rejected row.

A rule is ``(reason, failing_condition)``.  Rules are evaluated in list order
and the first failing one names the reject, exactly like a chain of
``if …: reject; continue``.  The result is one extra column, so a frame is
classified in a single projection and split by two filters on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import col_of

REASON = "reject_reason"

# ---------------------------------------------------------------------------
# Maximum lengths of the staged columns (must equal the source
# system's), and the reject texts it writes.
PRODUCT_MAX_LENGTHS = {
    "p_product_metadata_id": 7,
    "p_product_source_key": 10,
    "p_sales_rank_category": 50,
    "p_image_url": 225,
    "p_brand": 150,
    "pc_product_source_key": 10,
    "pc_category": 150,
    "rl_product_source_key": 10,
    "rl_related_product_source_key": 10,
    "rl_relation": 20,
}
REVIEW_MAX_LENGTHS = {
    "r_reviewer_source_key": 21,
    "r_product_key": 10,
}
REASONS = {
    "product_metadata_id": "product_metadata_id too long",
    "product_source_key": "product_source_key too long",
    "sales_rank_category": "sales_rank_category too long",
    "image_url": "image_url too long",
    "brand": "brand too long",
    "price": "invalid price",
    "category": "category too long",
    "categories_format": "invalid categories format",
    "related": "related product fields too long",
    "reviewer_id": "reviewer_id too long",
    "product_key": "product_key too long",
    "score": "Invalid review score",
    "helpful": "Invalid helpful rating",
    "datetime": "Invalid review date time rating",
}
# Reasons this library adds for rules the source system enforced by failing.
MALFORMED = "malformed record"
DUPLICATE_KEY = "duplicate key"
MISSING_KEY = "missing key"
# End of fixed values.
# ---------------------------------------------------------------------------

Rule = tuple[str, Column]


def too_long(c: str | Column, max_len: int) -> Column:
    """V1: longer than ``max_len`` characters (code points, like Python ``len``)."""
    return F.length(col_of(c)) > F.lit(max_len)


def first_failure(rules: Sequence[Rule]) -> Column:
    """V2: reason of the first failing rule, or null when all pass."""
    return F.coalesce(*[F.when(cond, F.lit(reason)) for reason, cond in rules])
