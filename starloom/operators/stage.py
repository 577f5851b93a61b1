"""Staging: raw CSV rows → stage 1 (L13, L14) → stage 2.

Stage 1 cleans and validates one source row per output row with the first
failing rule as the reject reason.  The classified frame is a single
projection over the scan; the loaders in :mod:`starloom.plans.pipeline`
write it once and derive accepted rows, children and rejects from the
written copy, so the CSV is parsed once.

Stage 2 removes duplicates (``DISTINCT``, then one row per primary key),
drops reciprocal related-product edges and adds placeholder products for
every referenced but unknown product key.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.literals import with_category_list, with_literal
from ..functions.numbers import py_float, py_int, ratio_round, seconds_to_timestamp
from ..functions.text import (PRODUCT_DEFAULTS, REVIEW_DEFAULTS, clean_text, default_if_blank,
                              is_blank)
from ..functions.dates import date_key
from . import validate as V
from .joins import canonical_edges, reciprocal_anti
from .key_index import dedupe_across
from .keys import latest_first, not_null_key
from .late import S2_PRODUCT_COLUMNS, add_late_arriving

REVIEW_SOURCE_COLUMNS = ["reviewerID", "asin", "reviewerName", "helpful", "reviewText", "overall",
                         "summary", "unixReviewTime"]
PRODUCT_SOURCE_COLUMNS = ["metadataid", "asin", "salesrank", "imurl", "categories", "title",
                          "description", "price", "related", "brand"]
S1_REVIEW_COLUMNS = ["r_reviewer_source_key", "r_product_key", "r_reviewer_name", "r_helpfulness_rating",
                     "r_review_text", "r_review_score", "r_review_title", "r_review_datetime"]
S1_CATEGORY_COLUMNS = ["pc_product_source_key", "pc_category"]
S1_RELATED_COLUMNS = ["rl_product_source_key", "rl_related_product_source_key", "rl_relation"]


CORRUPT = "_corrupt_record"


def _raw_json(cols: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def _with_malformed(raw: DataFrame, rules: list) -> list:
    """A scan's malformed rows (wrong field count) fail before any other rule."""
    if CORRUPT in raw.columns:
        return [(V.MALFORMED, F.col(CORRUPT).isNotNull()), *rules]
    return rules


def _source_row(raw: DataFrame, reason: Column) -> Column:
    """The source row as JSON, only for rejected rows (the raw line for malformed ones)."""
    present = [c for c in raw.columns if c != CORRUPT]
    row = _raw_json(present)
    if CORRUPT in raw.columns:
        row = F.coalesce(F.col(CORRUPT), row)
    return F.when(reason.isNotNull(), row)


# --------------------------------------------------------------------------- reviews

PENDING = "pending python parse"


def _helpful_rules(helpful: Column) -> tuple[Column, Column, Column]:
    """(valid?, first vote, second vote) of a parsed helpful list."""
    a, b = F.get(helpful, 0), F.get(helpful, 1)
    ok = helpful.isNotNull() & (F.size(helpful) >= 2) & b.isNotNull() & ((b == 0) | a.isNotNull())
    return ok, a, b


def classify_reviews(raw: DataFrame, ratio_mode: str = "half_up", python_fallback: str = "inline") -> DataFrame:
    """L13 core: stage-1 review columns, ``reject_reason`` and the source row as JSON.

    ``python_fallback='inline'`` parses helpful-vote text the JVM cannot read
    exactly with the Arrow fallback inside this projection.  ``'defer'``
    keeps this pass JVM-only: such rows (when no earlier rule already
    rejects them) get reason ``pending python parse`` plus the columns
    :func:`resolve_pending_reviews` needs, so Python later sees only those
    rows instead of every row of the scan.
    """
    if python_fallback not in ("inline", "defer"):
        raise ValueError("python_fallback must be 'inline' or 'defer'")
    d = REVIEW_DEFAULTS
    defer = python_fallback == "defer"
    df = with_literal(raw, "helpful", "_helpful", "array<double>", ("list", "tuple"), defer)
    needs_python = F.col("_helpful_need") if defer else F.lit(False)
    # Each parsed cell, then the reason, is a step of its own: read by several columns, computed once.
    df = df.withColumn("_secs", py_int("unixReviewTime"))
    df = df.withColumns({"_rid": default_if_blank("reviewerID", d["reviewer_source_key"]), "_pkey": default_if_blank("asin", d["product_key"]),
                         "_score": py_float("overall"), "_ts": seconds_to_timestamp(F.col("_secs"))})
    rid, pkey, score, ts = F.col("_rid"), F.col("_pkey"), F.col("_score"), F.col("_ts")
    helpful_ok, a, b = _helpful_rules(F.col("_helpful"))
    before_helpful = _with_malformed(raw, [
        (V.REASONS["reviewer_id"], V.too_long(rid, V.REVIEW_MAX_LENGTHS["r_reviewer_source_key"])),
        (V.REASONS["product_key"], V.too_long(pkey, V.REVIEW_MAX_LENGTHS["r_product_key"])),
        (V.REASONS["score"], score.isNull()),
    ])
    earlier = V.first_failure(before_helpful)
    pending = needs_python & earlier.isNull()
    rules = [*before_helpful, (PENDING, pending), (V.REASONS["helpful"], ~helpful_ok),
             (V.REASONS["datetime"], ts.isNull())]
    df = df.withColumns({"_pending": pending, "_reason": V.first_failure(rules)})
    pending, reason = F.col("_pending"), F.col("_reason")
    out = df.select(
        rid.alias("r_reviewer_source_key"), pkey.alias("r_product_key"),
        clean_text("reviewerName", d["reviewer_name"]).alias("r_reviewer_name"),
        # Defined for accepted rows (rejected ones keep only their source row).
        F.when(reason.isNull() & helpful_ok, ratio_round(a, b, ratio_mode)).alias("r_helpfulness_rating"),
        clean_text("reviewText", d["review_text"]).alias("r_review_text"),
        score.alias("r_review_score"),
        clean_text("summary", d["review_title"], strip=True).alias("r_review_title"),
        ts.alias("r_review_datetime"),
        reason.alias(V.REASON),
        _source_row(raw, reason).alias("_source_row"),
        *([pending.alias("_pending"), F.when(pending, F.col("helpful")).alias("_helpful_src")]
          if defer else []))
    return out


def resolve_pending_reviews(classified: DataFrame, ratio_mode: str = "half_up") -> DataFrame:
    """Finish the rows a deferred classification left ``pending``.

    Only those rows reach Python (the literal fallback on their helpful
    text); the helpful and review-time rules are applied in order, as in
    the inline pass.  Returns the same columns with ``_pending`` false.
    """
    pend = classified.filter(F.col("_pending"))
    pend = with_literal(pend, "_helpful_src", "_h", "array<double>", ("list", "tuple"))
    helpful_ok, a, b = _helpful_rules(F.col("_h"))
    reason = F.coalesce(F.when(~helpful_ok, F.lit(V.REASONS["helpful"])),
                        F.when(F.col("r_review_datetime").isNull(), F.lit(V.REASONS["datetime"])))
    return (pend.withColumn("r_helpfulness_rating",
                            F.when(reason.isNull() & helpful_ok, ratio_round(a, b, ratio_mode)))
            .withColumn(V.REASON, reason)
            .withColumn("_source_row", F.when(reason.isNotNull(), F.col("_source_row")))
            .withColumn("_pending", F.lit(False))
            .select(*classified.columns))


def review_outputs(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(s1_review rows, rejects) from a classified review frame."""
    ok = classified.filter(F.col(V.REASON).isNull()).select(*S1_REVIEW_COLUMNS)
    bad = classified.filter(F.col(V.REASON).isNotNull()).select(
        F.lit("s1_review").alias("entity"), F.col(V.REASON).alias("reason"), F.col("_source_row").alias("row"))
    return ok, bad


# --------------------------------------------------------------------------- products

def classify_products(raw: DataFrame, python_fallback: str = "inline") -> DataFrame:
    """L14 core: stage-1 product columns, parsed categories and relations, reason, source row.

    ``python_fallback`` as in :func:`classify_reviews`: ``'defer'`` marks
    products with a cell only Python reads exactly as pending (with their
    source row), for :func:`resolve_pending_products`.

    The source row is kept for rejected and pending products and for accepted
    ones with a child that will be rejected and cites it.
    """
    if python_fallback not in ("inline", "defer"):
        raise ValueError("python_fallback must be 'inline' or 'defer'")
    defer = python_fallback == "defer"
    d = PRODUCT_DEFAULTS
    df = with_literal(raw, "salesrank", "_salesrank", "map<string,int>", ("dict",), defer)
    df = with_category_list(df, "categories", "_categories", defer)
    df = with_literal(df, "related", "_related", "map<string,array<string>>", ("dict",), defer)
    first = F.try_element_at(F.map_entries(F.col("_salesrank")), F.lit(1))
    has_rank = first.isNotNull() & first["value"].isNotNull()
    rank_cat = F.when(has_rank, first["key"]).otherwise(F.lit(d["sales_rank_category"]))
    rank = F.when(has_rank, first["value"]).otherwise(F.lit(d["sales_rank"])).cast("int")
    price = F.when(is_blank("price"), F.lit(d["price"])).otherwise(py_float("price"))
    mid = default_if_blank("metadataid", d["metadata_id"])
    skey = default_if_blank("asin", d["source_key"])
    image = default_if_blank("imurl", d["image_url"])
    brand = clean_text("brand", d["brand"])
    L = V.PRODUCT_MAX_LENGTHS
    pending = F.lit(False)
    if defer:
        pending = F.col("_salesrank_need") | F.col("_categories_need") | F.col("_related_need")
        if CORRUPT in raw.columns:
            pending = pending & F.col(CORRUPT).isNull()
    rules = [
        (PENDING, pending),
        (V.REASONS["price"], price.isNull()),
        (V.REASONS["product_metadata_id"], V.too_long(mid, L["p_product_metadata_id"])),
        (V.REASONS["product_source_key"], V.too_long(skey, L["p_product_source_key"])),
        (V.REASONS["sales_rank_category"], V.too_long(rank_cat, L["p_sales_rank_category"])),
        (V.REASONS["image_url"], V.too_long(image, L["p_image_url"])),
        (V.REASONS["brand"], V.too_long(brand, L["p_brand"])),
    ]
    reason = V.first_failure(_with_malformed(raw, rules))
    cited = F.coalesce(reason, F.when(_has_bad_child(), F.lit("child")))
    return df.select(
        mid.alias("p_product_metadata_id"), skey.alias("p_product_source_key"),
        rank_cat.alias("p_sales_rank_category"), rank.alias("p_sales_rank"),
        image.alias("p_image_url"),
        clean_text("title", d["title"]).alias("p_title"),
        clean_text("description", d["description"]).alias("p_description"),
        price.alias("p_price"), brand.alias("p_brand"),
        F.col("_categories"), F.col("_categories_kind"),
        F.col("_related"), F.col("_related_kind"),
        reason.alias(V.REASON), _source_row(raw, cited).alias("_source_row"),
        *([pending.alias("_pending")] if defer else []))


def _has_bad_child() -> Column:
    """Whether a product has a category or relation that :func:`product_outputs` rejects."""
    L = V.PRODUCT_MAX_LENGTHS
    no_list = F.col("_categories_kind").isNull() | (F.col("_categories_kind") != "list")
    long_cat = F.exists("_categories", lambda c: V.too_long(c, L["pc_category"]))
    long_rel = F.exists(F.map_entries("_related"), lambda e: V.too_long(e["key"], L["rl_relation"])
                        | F.exists(e["value"], lambda k: V.too_long(k, L["rl_related_product_source_key"])))
    return no_list | F.coalesce(long_cat, F.lit(False)) | F.coalesce(long_rel, F.lit(False))


def resolve_pending_products(classified: DataFrame) -> DataFrame:
    """Classify the products a deferred pass left pending, literal fallback included.

    Their cells come back from the source row; a null cell is absent there
    and null again here.  Returns the same columns with ``_pending`` false.
    """
    cells = ", ".join(f"`{c}` string" for c in PRODUCT_SOURCE_COLUMNS)
    pend = classified.filter("_pending").select(F.from_json("_source_row", cells).alias("_r"), F.col("_source_row").alias("_kept"))
    raw = pend.select("_r.*", "_kept")
    done = classify_products(raw)
    # the scan's own rendering of the row, with any further columns, stays the source row
    return done.withColumn("_source_row", F.get_json_object("_source_row", "$._kept")) \
        .withColumn("_pending", F.lit(False)).select(*classified.columns)


class ProductOutputs(NamedTuple):
    products: DataFrame
    categories: DataFrame
    related: DataFrame
    rejects: DataFrame


def product_outputs(classified: DataFrame) -> ProductOutputs:
    """(s1_product, s1_product_category, s1_related_product, rejects) of classified products.

    V5 cascade: rejected products yield no children; a product whose
    categories are not a list yields no relations (but is kept); a related
    value that is not a dict yields no relations (D21).
    """
    L = V.PRODUCT_MAX_LENGTHS
    accepted = classified.filter(F.col(V.REASON).isNull())
    products = accepted.select(*S2_PRODUCT_COLUMNS)
    rej_products = classified.filter(F.col(V.REASON).isNotNull()).select(
        F.lit("s1_product").alias("entity"), F.col(V.REASON).alias("reason"), F.col("_source_row").alias("row"))

    is_list = F.col("_categories_kind") == "list"
    bad_format = accepted.filter(~is_list | F.col("_categories_kind").isNull()).select(
        F.lit("s1_product_category").alias("entity"), F.lit(V.REASONS["categories_format"]).alias("reason"),
        F.col("_source_row").alias("row"))
    cats = accepted.filter(is_list).select(
        "p_product_source_key", "_source_row", F.explode("_categories").alias("pc_category"))
    long_cat = V.too_long("pc_category", L["pc_category"])
    categories = cats.filter(~long_cat).select(F.col("p_product_source_key").alias("pc_product_source_key"),
                                               "pc_category")
    rej_cats = cats.filter(long_cat).select(
        F.lit("s1_product_category").alias("entity"), F.lit(V.REASONS["category"]).alias("reason"),
        F.col("_source_row").alias("row"))

    rel = (accepted.filter(is_list & (F.col("_related_kind") == "dict"))
           .select("p_product_source_key", "_source_row", F.explode("_related").alias("rl_relation", "_items"))
           .select("p_product_source_key", "_source_row", "rl_relation",
                   F.explode("_items").alias("rl_related_product_source_key")))
    long_rel = (V.too_long("rl_related_product_source_key", L["rl_related_product_source_key"])
                | V.too_long("rl_relation", L["rl_relation"]))
    related = rel.filter(~long_rel).select(F.col("p_product_source_key").alias("rl_product_source_key"),
                                           "rl_related_product_source_key", "rl_relation")
    rej_rel = rel.filter(long_rel).select(
        F.lit("s1_related_products").alias("entity"), F.lit(V.REASONS["related"]).alias("reason"),
        F.col("_source_row").alias("row"))
    rejects = rej_products.unionByName(bad_format).unionByName(rej_cats).unionByName(rej_rel)
    return ProductOutputs(products, categories, related, rejects)


# --------------------------------------------------------------------------- stage 2

class Stage2(NamedTuple):
    products: DataFrame
    reviews: DataFrame
    categories: DataFrame
    related: DataFrame
    placeholders: DataFrame
    rejects: DataFrame


def stage2_products(s1_product: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct products, one per source key (PK, never null); the rest quarantined.

    The key rule collapses exact copies itself, so no separate DISTINCT
    shuffle is needed.
    """
    return _keyed(s1_product.select(*S2_PRODUCT_COLUMNS), ["p_product_source_key"])


def _keyed(df: DataFrame, keys: list[str], prefer: list[Column] | None = None,
           seen: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """A primary key enforced: not null (K2), then unique (K1), also against the keys of earlier batches."""
    whole, missing = not_null_key(df, keys)
    kept, dropped = dedupe_across(whole, keys, seen, prefer)
    return kept, dropped.unionByName(missing)


REVIEW_KEY = ["r_reviewer_source_key", "r_product_key"]


def stage2_reviews(s1_review: DataFrame, seen: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct reviews, one per (reviewer, product) (PK), newest review first.

    ``seen`` holds the keys of earlier batches with the digest of their row: a key
    stays with the row that took it first.
    """
    return _keyed(s1_review.select(*S1_REVIEW_COLUMNS), REVIEW_KEY, prefer=[latest_first("r_review_datetime")], seen=seen)


def stage2_related(s1_related: DataFrame, mode: str = "literal", met: DataFrame | None = None) -> DataFrame:
    """J1 (literal: reciprocal edges dropped both ways) or D9 canonical pairs.

    ``met`` holds the pairs and directions that earlier batches have met.
    """
    edges = s1_related.select(*S1_RELATED_COLUMNS)
    if mode == "literal":
        return reciprocal_anti(edges, "rl_product_source_key", "rl_related_product_source_key", met)
    if mode == "canonical":
        return canonical_edges(edges, "rl_product_source_key", "rl_related_product_source_key", "rl_relation")
    raise ValueError("mode must be 'literal' or 'canonical'")


def stage2_categories(s1_category: DataFrame) -> DataFrame:
    """Distinct (product, category) pairs."""
    return s1_category.select(*S1_CATEGORY_COLUMNS).distinct()


def stage2_members(products: DataFrame, reviews: DataFrame, categories: DataFrame, related: DataFrame,
                   known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(products with a placeholder for every key that is referenced but unknown, the placeholders alone)."""
    return add_late_arriving(products, [
        (reviews, "r_product_key"), (categories, "pc_product_source_key"),
        (related, "rl_product_source_key"), (related, "rl_related_product_source_key")], known)


def dedup_stage(s1_product: DataFrame, s1_review: DataFrame, s1_category: DataFrame,
                s1_related: DataFrame, related_mode: str = "literal",
                known_products: DataFrame | None = None, seen_reviews: DataFrame | None = None,
                met_edges: DataFrame | None = None) -> Stage2:
    """Stage 2 with keys enforced and late-arriving products added.

    Of earlier batches, ``known_products`` are the source keys loaded,
    ``seen_reviews`` the review keys taken (with row digests) and ``met_edges`` the
    related pairs met, by direction.  Products and categories are snapshots: the
    same key in a later batch is its next state, not a duplicate.
    """
    products, dup_p = stage2_products(s1_product)
    reviews, dup_r = stage2_reviews(s1_review, seen_reviews)
    categories = stage2_categories(s1_category)
    related = stage2_related(s1_related, related_mode, met_edges)
    products_all, placeholders = stage2_members(products, reviews, categories, related, known_products)
    rejects = (dup_p.select(F.lit("s2_product").alias("entity"), F.col(V.REASON).alias("reason"),
                            F.to_json(F.struct(*S2_PRODUCT_COLUMNS)).alias("row"))
               .unionByName(dup_r.select(F.lit("s2_review").alias("entity"), F.col(V.REASON).alias("reason"),
                                         F.to_json(F.struct(*S1_REVIEW_COLUMNS)).alias("row"))))
    return Stage2(products_all, reviews, categories, related, placeholders, rejects)


def review_view(s2_review: DataFrame) -> DataFrame:
    """P22 ``v_s2_review``: stage-2 reviews with the ``yyyyMMdd`` date key."""
    return s2_review.select(*[c for c in S1_REVIEW_COLUMNS if c != "r_review_datetime"],
                            "r_review_datetime", date_key("r_review_datetime").alias("r_review_date_key"))
