"""Registered queries: one per operator id of the survey, each with its
Spark implementation (through the library) and an independent DuckDB SQL
oracle over the same test tables.

Every query reads the whole test tables (or stand-in rows derived from
them); none caps, samples or filters ids to stay cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import literals as L
from ..functions import numbers as N
from ..functions import text as T
from ..operators import bridge as B
from ..operators import dims as Dm
from ..operators import fact as Fa
from ..operators import joins as J
from ..operators import keys as K
from ..operators import setops as U
from ..operators import stage as St
from ..operators import validate as V
from ..session import compiled_methods, finished_shuffles_removed, materialize
from . import oracle as O
from . import standin as S
from . import star
from . import warehouse as W

AS_OF_1, AS_OF_2, AS_OF_3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


_CACHE: dict[tuple, object] = {}


def _memo(key: tuple, build):
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def warehouse(spark: SparkSession, sf: str) -> W.Warehouse:
    """The stand-in warehouse (first load), built once per session and folder."""
    return _memo(("wh", spark.sparkContext.applicationId, sf), lambda: W.build_warehouse(
        S.raw_reviews(spark, sf), S.raw_products(spark, sf), AS_OF_1))


def late_products(spark: SparkSession, sf: str) -> St.ProductOutputs:
    """The second product file, classified once per session and folder."""
    return _memo(("late_products", spark.sparkContext.applicationId, sf), lambda: St.product_outputs(
        W.classified_products(S.raw_products(spark, sf, late=True))))


def late_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Second product file (all parts, late ones with real attributes), key-deduplicated."""
    def build():
        kept, _ = St.stage2_products(late_products(spark, sf).products)
        return W.product_snapshot(kept)
    return _memo(("late", spark.sparkContext.applicationId, sf), build)


def product_dim_v2(spark: SparkSession, sf: str) -> DataFrame:
    wh = warehouse(spark, sf)
    return _memo(("pd2", spark.sparkContext.applicationId, sf), lambda: Dm.scd2_merge(
        wh.product, late_snapshot(spark, sf), W.PRODUCT_KEY, list(W.PRODUCT_ATTRS.values()), AS_OF_2)[0])


# SQL pieces shared by oracles -----------------------------------------------------------
PRODUCT_COLS = ", ".join(W.PRODUCT_DIM_COLUMNS)
SNAP2 = """snap2 AS (
  SELECT p_product_source_key AS product_source_key, p_product_metadata_id AS product_metadata_id,
         p_sales_rank_category AS sales_rank_category, p_sales_rank AS sales_rank,
         p_image_url AS product_image_url, p_title AS product_title, p_description AS product_description,
         p_price AS price, p_brand AS brand FROM s2_product_k_late)"""
ATTRS = list(W.PRODUCT_ATTRS.values())
CHANGED = " OR ".join(f"s.{a} IS DISTINCT FROM c.{a}" for a in ATTRS)
PRODUCT_DIM_2 = f""", {SNAP2},
m AS (SELECT s.*, c.product_key AS old_key, ({CHANGED}) AS changed
      FROM snap2 s LEFT JOIN product_dim c ON c.is_current AND c.product_source_key = s.product_source_key),
product_dim_2 AS (
  SELECT product_key, product_source_key, {", ".join(ATTRS)}, effective_date,
         CASE WHEN product_key IN (SELECT old_key FROM m WHERE changed AND old_key IS NOT NULL) AND is_current
              THEN TIMESTAMP '{AS_OF_2}' ELSE expiration_date END AS expiration_date,
         CASE WHEN product_key IN (SELECT old_key FROM m WHERE changed AND old_key IS NOT NULL) AND is_current
              THEN false ELSE is_current END AS is_current
  FROM product_dim
  UNION ALL
  SELECT (SELECT max(product_key) FROM product_dim) + row_number() OVER (ORDER BY product_source_key),
         product_source_key, {", ".join(ATTRS)}, TIMESTAMP '{AS_OF_2}', CAST(NULL AS TIMESTAMP), true
  FROM m WHERE old_key IS NULL OR changed)
"""


# Star queries ----------------------------------------------------------------------------

@register("q1_rating_per_category_per_month", O.query("""
SELECT c.product_category, d.year, d.month_of_year, AVG(f.review_rating) AS avg_review_rating
FROM review_fact f JOIN product_dim p ON f.product_key = p.product_key
JOIN bridge_dim b ON p.product_key = b.product_key JOIN category_dim c ON b.category_key = c.category_key
JOIN date_dim d ON f.date_reviewed_key = d.date_key
GROUP BY c.product_category, d.year, d.month_of_year"""))
def q1(spark, sf):
    wh = warehouse(spark, sf)
    return star.rating_per_category_per_month(wh.fact, wh.product, wh.bridge, wh.category, wh.date)


@register("q2_rating_per_brand_per_month", O.query("""
SELECT p.brand, d.year, d.month_of_year, AVG(f.review_rating) AS avg_review_rating
FROM review_fact f JOIN product_dim p ON f.product_key = p.product_key
JOIN date_dim d ON f.date_reviewed_key = d.date_key
GROUP BY p.brand, d.year, d.month_of_year"""))
def q2(spark, sf):
    wh = warehouse(spark, sf)
    return star.rating_per_brand_per_month(wh.fact, wh.product, wh.date)


@register("t1_order_by", O.query("""
SELECT * EXCLUDE (m), row_number() OVER (ORDER BY year, m, brand) AS position FROM (
  SELECT p.brand, d.year, d.month_of_year, AVG(f.review_rating) AS avg_review_rating, min(d.month_of_year_number) AS m
  FROM review_fact f JOIN product_dim p ON f.product_key = p.product_key
  JOIN date_dim d ON f.date_reviewed_key = d.date_key
  GROUP BY p.brand, d.year, d.month_of_year)"""))
def t1(spark, sf):
    """The ordered query's rows with their place, so that the order itself is compared.

    Each sorted partition is numbered as it stands; the partitions' sizes, one row
    each, tell where it starts.
    """
    wh = warehouse(spark, sf)
    ordered = star.rating_per_brand_per_month(wh.fact, wh.product, wh.date, month_order=star.MONTH_ORDER_NUMBER)
    placed = materialize(ordered.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i")))
    size = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_0"))
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    start = size.select("_p", "_0", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return placed.join(start, "_p").withColumn("position", F.col("_before") + F.col("_i") - F.col("_0") + 1) \
        .drop("_p", "_i", "_0", "_before")


@register("a3_avg_group", O.query("""
SELECT c.product_category, d.year, d.month_of_year, AVG(f.review_rating) AS avg_review_rating
FROM review_fact f JOIN product_dim p ON f.product_key = p.product_key
JOIN bridge_dim b ON p.product_key = b.product_key JOIN category_dim c ON b.category_key = c.category_key
JOIN date_dim d ON f.date_reviewed_key = d.date_key
GROUP BY c.product_category, d.year, d.month_of_year"""))
def a3(spark, sf):
    wh = warehouse(spark, sf)
    return star.rating_per_category_per_month(wh.fact, wh.product, wh.bridge, wh.category, wh.date,
                                              month_order=star.MONTH_ORDER_NUMBER)


@register("j7_star_join", O.query("""
SELECT f.date_reviewed_key, f.reviewer_key, f.product_key, f.review_descriptors_key, p.brand, d.year,
       d.month_of_year, f.review_rating
FROM review_fact f JOIN product_dim p ON f.product_key = p.product_key
JOIN date_dim d ON f.date_reviewed_key = d.date_key"""))
def j7(spark, sf):
    wh = warehouse(spark, sf)
    d = F.broadcast(wh.date.select("date_key", "year", "month_of_year"))
    return (wh.fact.join(wh.product.select("product_key", "brand"), "product_key")
            .join(d, F.col("date_reviewed_key") == F.col("date_key"))
            .select("date_reviewed_key", "reviewer_key", "product_key", "review_descriptors_key", "brand",
                    "year", "month_of_year", "review_rating"))


@register("j8_bridge_star_join", O.query("""
SELECT f.date_reviewed_key, f.reviewer_key, f.product_key, f.review_descriptors_key, c.product_category,
       d.year, d.month_of_year, f.review_rating
FROM review_fact f JOIN product_dim p ON f.product_key = p.product_key
JOIN bridge_dim b ON p.product_key = b.product_key JOIN category_dim c ON b.category_key = c.category_key
JOIN date_dim d ON f.date_reviewed_key = d.date_key"""))
def j8(spark, sf):
    wh = warehouse(spark, sf)
    d = F.broadcast(wh.date.select("date_key", "year", "month_of_year"))
    return (wh.fact.join(wh.product.select("product_key"), "product_key")
            .join(wh.bridge, "product_key").join(wh.category, "category_key")
            .join(d, F.col("date_reviewed_key") == F.col("date_key"))
            .select("date_reviewed_key", "reviewer_key", "product_key", "review_descriptors_key",
                    "product_category", "year", "month_of_year", "review_rating"))


# Stage 1 ---------------------------------------------------------------------------------

@register("l13_stage_reviews", O.query(" SELECT * FROM s1_review"))
def l13(spark, sf):
    return warehouse(spark, sf).stage1.reviews


@register("v2_first_failure_reason", O.query(
    """ SELECT _c0 AS source_row_id, reject_reason AS reason FROM rc WHERE reject_reason IS NOT NULL
UNION ALL SELECT p_product_metadata_id, reject_reason FROM pc WHERE reject_reason IS NOT NULL"""))
def v2(spark, sf):
    """Review and product rejects with the first rule they break; every product rule fires."""
    _, bad = St.review_outputs(St.classify_reviews(S.raw_reviews(spark, sf)))
    products = St.classify_products(S.raw_products(spark, sf)).filter(F.col(V.REASON).isNotNull())
    return bad.select(F.get_json_object("row", "$._c0").alias("source_row_id"), "reason").unionByName(
        products.select(F.get_json_object("_source_row", "$.metadataid").alias("source_row_id"), F.col(V.REASON).alias("reason")))


@register("s7_quarantine_rows", O.query("""
SELECT 's1_review' AS entity, reject_reason AS reason, count(*) AS n FROM rc
WHERE reject_reason IS NOT NULL GROUP BY ALL
UNION ALL SELECT 's1_product', reject_reason, count(*) FROM pc WHERE reject_reason IS NOT NULL GROUP BY ALL
UNION ALL SELECT 's1_product_category', 'invalid categories format', count(*) FROM pc WHERE reject_reason IS NULL AND _cats IS NULL
HAVING count(*) > 0"""))
def s7(spark, sf):
    from ..sources import sinks
    from ..session import scratch_path
    path = scratch_path(spark, "quarantine")
    sinks.write_quarantine(warehouse(spark, sf).stage1.rejects, path)
    return spark.read.json(path).groupBy("entity", "reason").agg(F.count(F.lit(1)).alias("n"))


@register("l14_stage_products", O.query(" SELECT * FROM s1_product"))
def l14(spark, sf):
    return warehouse(spark, sf).stage1.products


@register("p19_explode_categories", O.query(" SELECT * FROM s1_product_category"))
def p19(spark, sf):
    return warehouse(spark, sf).stage1.categories


@register("p20_explode_relations", O.query(" SELECT * FROM s1_related_product"))
def p20(spark, sf):
    return warehouse(spark, sf).stage1.related


@register("v5_cascade_skip", O.query("""
SELECT p.p_product_source_key AS product_source_key,
       (SELECT count(*) FROM s1_product_category c WHERE c.pc_product_source_key = p.p_product_source_key)
         AS n_categories,
       (SELECT count(*) FROM s1_related_product r WHERE r.rl_product_source_key = p.p_product_source_key)
         AS n_relations
FROM pc p WHERE p.reject_reason IS NULL""", late_products=True))
def v5(spark, sf):
    po = late_products(spark, sf)
    cats = po.categories.groupBy("pc_product_source_key").agg(F.count(F.lit(1)).alias("n_categories"))
    rels = po.related.groupBy("rl_product_source_key").agg(F.count(F.lit(1)).alias("n_relations"))
    return (po.products.select(F.col("p_product_source_key").alias("product_source_key"))
            .join(cats, F.col("product_source_key") == F.col("pc_product_source_key"), "left")
            .join(rels, F.col("product_source_key") == F.col("rl_product_source_key"), "left")
            .select("product_source_key", F.coalesce("n_categories", F.lit(0)).alias("n_categories"),
                    F.coalesce("n_relations", F.lit(0)).alias("n_relations")))


# Stage 2 ---------------------------------------------------------------------------------

@register("l12_dedup_stage", O.query(" SELECT * FROM s2_product"))
def l12(spark, sf):
    s1 = warehouse(spark, sf).stage1
    return St.dedup_stage(s1.products, s1.reviews, s1.categories, s1.related).products


@register("k1_unique_key", O.query(" SELECT * FROM s2_review"))
def k1(spark, sf):
    return warehouse(spark, sf).stage2.reviews


@register("k1_duplicate_key_rejects", O.query("""
SELECT r_reviewer_source_key, r_product_key, count(*) AS n_rejected FROM (
  SELECT DISTINCT * FROM s1_review) x
WHERE NOT EXISTS (SELECT 1 FROM s2_review k
  WHERE k.r_reviewer_source_key = x.r_reviewer_source_key AND k.r_product_key = x.r_product_key
    AND k.r_reviewer_name IS NOT DISTINCT FROM x.r_reviewer_name
    AND k.r_helpfulness_rating IS NOT DISTINCT FROM x.r_helpfulness_rating
    AND k.r_review_text IS NOT DISTINCT FROM x.r_review_text
    AND k.r_review_score IS NOT DISTINCT FROM x.r_review_score
    AND k.r_review_title IS NOT DISTINCT FROM x.r_review_title
    AND k.r_review_datetime IS NOT DISTINCT FROM x.r_review_datetime)
GROUP BY ALL"""))
def k1_rejects(spark, sf):
    _, dups = St.stage2_reviews(warehouse(spark, sf).stage1.reviews)
    return dups.groupBy("r_reviewer_source_key", "r_product_key").agg(F.count(F.lit(1)).alias("n_rejected"))


@register("a1_distinct_rows", O.query(" SELECT DISTINCT * FROM s1_product_category"))
def a1(spark, sf):
    return U.distinct_rows(warehouse(spark, sf).stage1.categories)


@register("a2_distinct_cols", O.query(" SELECT DISTINCT r_reviewer_source_key, r_reviewer_name FROM s2_review"))
def a2(spark, sf):
    return U.distinct_cols(warehouse(spark, sf).stage2.reviews, ["r_reviewer_source_key", "r_reviewer_name"])


@register("j1_reciprocal_anti", O.query(" SELECT * FROM s2_related_product"))
def j1(spark, sf):
    return warehouse(spark, sf).stage2.related


@register("d9_canonical_edges", O.query("""
SELECT DISTINCT least(rl_product_source_key, rl_related_product_source_key) AS rl_product_source_key,
       greatest(rl_product_source_key, rl_related_product_source_key) AS rl_related_product_source_key,
       rl_relation FROM s1_related_product"""))
def d9(spark, sf):
    return St.stage2_related(warehouse(spark, sf).stage1.related, mode="canonical")


@register("p16_least_greatest", O.query("""
SELECT DISTINCT least(rl_product_source_key, rl_related_product_source_key) AS pair_lo,
       greatest(rl_product_source_key, rl_related_product_source_key) AS pair_hi FROM s1_related_product"""))
def p16(spark, sf):
    lo, hi = T.pair_key("rl_product_source_key", "rl_related_product_source_key")
    return warehouse(spark, sf).stage1.related.select(lo.alias("pair_lo"), hi.alias("pair_hi")).distinct()


@register("l10_late_arriving_members", O.query(" SELECT * FROM placeholders"))
def l10(spark, sf):
    return warehouse(spark, sf).stage2.placeholders


@register("u1_except_keys", O.query(" SELECT * FROM missing_products"))
def u1(spark, sf):
    wh = warehouse(spark, sf)
    kept, _ = St.stage2_products(wh.stage1.products)
    s2 = wh.stage2
    refs = s2.reviews.select(F.col("r_product_key").alias("k")).unionByName(
        s2.categories.select(F.col("pc_product_source_key").alias("k"))).unionByName(
        s2.related.select(F.col("rl_product_source_key").alias("k"))).unionByName(
        s2.related.select(F.col("rl_related_product_source_key").alias("k")))
    return U.except_keys(refs, kept, "k", "p_product_source_key").withColumnRenamed("k", "p_product_source_key")


@register("j10_fk_check", O.query("""
SELECT r_reviewer_source_key, r_product_key, 'unknown product' AS reason FROM s2_review r
WHERE NOT EXISTS (SELECT 1 FROM s2_product_k p WHERE p.p_product_source_key = r.r_product_key)"""))
def j10(spark, sf):
    wh = warehouse(spark, sf)
    kept, _ = St.stage2_products(wh.stage1.products)
    _, orphans = K.fk_split(wh.stage2.reviews, kept, [("r_product_key", "p_product_source_key")],
                            B.UNKNOWN_PRODUCT)
    return orphans.select("r_reviewer_source_key", "r_product_key", F.col(V.REASON).alias("reason"))


@register("k3_fk", O.query("""
SELECT r_reviewer_source_key, r_product_key FROM s2_review r
WHERE EXISTS (SELECT 1 FROM s2_product_k p WHERE p.p_product_source_key = r.r_product_key)"""))
def k3(spark, sf):
    wh = warehouse(spark, sf)
    kept, _ = St.stage2_products(wh.stage1.products)
    ok, _ = K.fk_split(wh.stage2.reviews, kept, [("r_product_key", "p_product_source_key")], B.UNKNOWN_PRODUCT)
    return ok.select("r_reviewer_source_key", "r_product_key")


@register("p22_view_project", O.query(" SELECT * FROM s2_review_view"))
def p22(spark, sf):
    return St.review_view(warehouse(spark, sf).stage2.reviews)


# Dimensions ------------------------------------------------------------------------------

@register("l2_build_date_dim", O.query(" SELECT * FROM date_dim"))
def l2(spark, sf):
    return warehouse(spark, sf).date


@register("l2_date_dim_orders", f"""
WITH y AS (SELECT date_trunc('year', min(o_orderdate))::DATE AS lo, year(max(o_orderdate)) - year(min(o_orderdate)) + 1 AS n FROM orders),
d AS (SELECT unnest(generate_series(lo, lo + to_years(n::INTEGER), INTERVAL 1 DAY))::DATE AS d FROM y),
o AS (SELECT o_orderdate::DATE AS d, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT {O.date_columns('d.d')}, coalesce(n_orders, 0) AS n_orders FROM d LEFT JOIN o ON d.d = o.d""")
def l2_orders(spark, sf):
    """The generated date dimension over the years of all orders, with the orders of each day."""
    orders = table(spark, sf, "orders")
    years = orders.agg(F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi")).first()
    lo, hi = (years.lo, years.hi) if years.lo is not None else (2000, 2000)
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("n_orders"))
    return Dm.build_date_dim(spark, f"{lo:04d}-01-01", hi - lo + 1).join(per_day, "date", "left").na.fill(0, ["n_orders"])


@register("l4_scd1_upsert", O.query(" SELECT * FROM reviewer_dim"))
def l4(spark, sf):
    return warehouse(spark, sf).reviewer


@register("l4_scd1_second_load", O.query("""
, inc AS (SELECT 'A' || CAST(c_custkey AS VARCHAR) AS reviewer_source_key, c_name || ' (' || c_mktsegment || ')'
                 AS reviewer_name FROM customer),
upd AS (SELECT d.reviewer_key, d.reviewer_source_key, coalesce(i.reviewer_name, d.reviewer_name) AS reviewer_name
        FROM reviewer_dim d LEFT JOIN inc i ON i.reviewer_source_key = d.reviewer_source_key),
new AS (SELECT (SELECT max(reviewer_key) FROM reviewer_dim) + row_number() OVER (ORDER BY reviewer_source_key)
               AS reviewer_key, reviewer_source_key, reviewer_name
        FROM inc WHERE reviewer_source_key NOT IN (SELECT reviewer_source_key FROM reviewer_dim))
SELECT * FROM upd UNION ALL SELECT * FROM new"""))
def l4b(spark, sf):
    """Second SCD1 load: every customer arrives again with an edited name."""
    cust = table(spark, sf, "customer")
    inc = cust.select(F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("reviewer_source_key"),
                      F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("reviewer_name"),
                      F.lit(AS_OF_2).cast("timestamp_ntz").alias("review_datetime"))
    dim, _ = Dm.scd1_upsert(warehouse(spark, sf).reviewer, inc)
    return dim


@register("l5_scd2_merge", O.query(PRODUCT_DIM_2 + " SELECT * FROM product_dim_2"))
def l5(spark, sf):
    return product_dim_v2(spark, sf)


@register("l5_scd2_first_load", O.query(f" SELECT {PRODUCT_COLS} FROM product_dim"))
def l5_first(spark, sf):
    return warehouse(spark, sf).product


@register("l5b_scd2_history", O.query(PRODUCT_DIM_2 + " SELECT * FROM product_dim_2"))
def l5b(spark, sf):
    wh = warehouse(spark, sf)
    snap1 = W.product_snapshot(wh.stage2.products).withColumn("as_of", F.lit(AS_OF_1).cast("timestamp_ntz"))
    snap2 = late_snapshot(spark, sf).withColumn("as_of", F.lit(AS_OF_2).cast("timestamp_ntz"))
    return Dm.scd2_history(snap1.unionByName(snap2), W.PRODUCT_KEY, ATTRS).select(*W.PRODUCT_DIM_COLUMNS)


@register("v6_is_current", O.query(PRODUCT_DIM_2 + " SELECT product_key, product_source_key FROM product_dim_2 "
                                   "WHERE is_current"))
def v6(spark, sf):
    return B.current_products(product_dim_v2(spark, sf)).select("product_key", "product_source_key")


@register("u2_union_append", O.query(" SELECT * FROM s1_product UNION ALL SELECT * FROM s1_product_late"))
def u2(spark, sf):
    """The products of the second file appended to those of the first."""
    late = late_products(spark, sf).products
    return U.append(warehouse(spark, sf).stage1.products, late)


@register("j5_match_split", O.query(PRODUCT_DIM_2 + """ SELECT product_source_key,
  CASE WHEN old_key IS NULL THEN 'insert' ELSE 'update' END AS action FROM m"""))
def j5(spark, sf):
    snap = late_snapshot(spark, sf)
    cur = B.current_products(warehouse(spark, sf).product)
    upd, ins = J.match_split(snap.select(W.PRODUCT_KEY), cur, [W.PRODUCT_KEY])
    return upd.withColumn("action", F.lit("update")).unionByName(ins.withColumn("action", F.lit("insert")))


@register("l3_load_category", O.query(" SELECT * FROM category_dim"))
def l3(spark, sf):
    return warehouse(spark, sf).category


@register("l6_load_bridge", O.query(" SELECT * FROM bridge_dim"))
def l6(spark, sf):
    return warehouse(spark, sf).bridge


@register("j6_bridge_combo_anti", O.query(PRODUCT_DIM_2 + """ SELECT DISTINCT p.product_key, c.category_key
FROM s1_product_category_late b
JOIN product_dim_2 p ON p.is_current AND p.product_source_key = b.pc_product_source_key
JOIN category_dim c ON c.product_category = b.pc_category
WHERE NOT EXISTS (SELECT 1 FROM bridge_dim x WHERE x.product_key = p.product_key
                  AND x.category_key = c.category_key)"""))
def j6(spark, sf):
    """Bridge pairs of the second product file that the first load did not have."""
    wh = warehouse(spark, sf)
    po = late_products(spark, sf)
    _, added, _ = B.load_bridge(po.categories, product_dim_v2(spark, sf), wh.category, existing=wh.bridge)
    return added


@register("l7_load_junk_dim", O.query(" SELECT * FROM junk_dim"))
def l7(spark, sf):
    reviews = warehouse(spark, sf).stage2.reviews
    return Dm.load_junk_dim(None, reviews.select(F.col("r_review_text").alias("review_text"), F.col("r_review_title").alias("review_title")))[0]


@register("p17_md5_hash", """SELECT doc_id, md5(text) AS text_md5 FROM documents""")
def p17(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.text_hash("text").alias("text_md5"))


@register("l8_load_related", O.query(" SELECT * FROM related_dim"))
def l8(spark, sf):
    return warehouse(spark, sf).related


@register("j4_lookup_role_playing", O.query(" SELECT * FROM related_dim"))
def j4(spark, sf):
    wh = warehouse(spark, sf)
    _, added, _ = B.load_related(wh.stage2.related, wh.product)
    return added


@register("s6_insert_ignore", O.query("""
SELECT primary_product_key, secondary_product_key, min(relation) AS relation FROM (
  SELECT p1.product_key AS primary_product_key, p2.product_key AS secondary_product_key, r.rl_relation AS relation
  FROM s1_related_product r
  JOIN product_dim p1 ON p1.is_current AND p1.product_source_key = r.rl_product_source_key
  JOIN product_dim p2 ON p2.is_current AND p2.product_source_key = r.rl_related_product_source_key)
x WHERE NOT EXISTS (SELECT 1 FROM related_dim d WHERE d.primary_product_key = x.primary_product_key
                    AND d.secondary_product_key = x.secondary_product_key)
GROUP BY 1, 2"""))
def s6(spark, sf):
    """Insert-ignore of all stage-1 edges (reciprocal ones included) into the loaded table."""
    from ..sources import sinks
    wh = warehouse(spark, sf)
    cur = B.current_products(wh.product)
    e = (wh.stage1.related
         .join(cur.select(F.col("product_source_key").alias("rl_product_source_key"),
                          F.col("product_key").alias("primary_product_key")), "rl_product_source_key")
         .join(cur.select(F.col("product_source_key").alias("rl_related_product_source_key"),
                          F.col("product_key").alias("secondary_product_key")), "rl_related_product_source_key")
         .select("primary_product_key", "secondary_product_key", F.col("rl_relation").alias("relation")))
    return sinks.insert_ignore(e, wh.related, ["primary_product_key", "secondary_product_key"])


@register("u3_set_union", O.query("""
SELECT primary_product_key AS product_key FROM related_dim UNION
SELECT secondary_product_key FROM related_dim"""))
def u3(spark, sf):
    r = warehouse(spark, sf).related
    return U.key_union(r, "primary_product_key", r, "secondary_product_key", "product_key")


@register("a6_distinct_keys", O.query(" SELECT DISTINCT rl_related_product_source_key FROM s2_related_product"))
def a6(spark, sf):
    return U.distinct_cols(warehouse(spark, sf).stage2.related, ["rl_related_product_source_key"])


# Fact ------------------------------------------------------------------------------------

@register("l9_load_fact", O.query(" SELECT * FROM review_fact"))
def l9(spark, sf):
    return warehouse(spark, sf).fact


@register("l9_fact_rerun_adds_nothing", O.query(" SELECT * FROM review_fact WHERE false"))
def l9_rerun(spark, sf):
    wh = warehouse(spark, sf)
    again, _, _ = Fa.load_fact(St.review_view(wh.stage2.reviews), wh.reviewer, wh.product, wh.junk_keys, wh.date,
                               existing=wh.fact)
    return again


@register("v9_key_not_null", O.query(" SELECT * FROM fact_resolved"))
def v9(spark, sf):
    wh = warehouse(spark, sf)
    j = Fa.resolve_fact_keys(St.review_view(wh.stage2.reviews), wh.reviewer, wh.product, wh.junk_keys, wh.date)
    return j.filter(F.col(V.REASON).isNull()).select(*Fa.FACT_COLUMNS)


@register("j2_lookup_key", O.query("""
SELECT r.r_reviewer_source_key, r.r_product_key, rv.reviewer_key FROM s2_review r
LEFT JOIN reviewer_dim rv ON rv.reviewer_source_key = r.r_reviewer_source_key"""))
def j2(spark, sf):
    wh = warehouse(spark, sf)
    return J.lookup(wh.stage2.reviews.select("r_reviewer_source_key", "r_product_key"), wh.reviewer,
                    [("r_reviewer_source_key", "reviewer_source_key")], ["reviewer_key"])


@register("j3_lookup_composite", O.query("""
SELECT r.r_reviewer_source_key, r.r_product_key, j.review_descriptors_key FROM s2_review r
LEFT JOIN junk_dim j ON j.review_text = r.r_review_text AND j.review_title = r.r_review_title"""))
def j3(spark, sf):
    wh = warehouse(spark, sf)
    text = ("r_review_text", "r_review_title")  # compared by hash and digest: no text is shuffled
    r = wh.stage2.reviews.select("r_reviewer_source_key", "r_product_key", Dm.descriptor_hash(*text).alias("_h"), Dm.descriptor_digest(*text).alias("_d"))
    out = J.lookup(r, wh.junk_keys, [("_h", "descriptor_hash"), ("_d", "digest")], ["review_descriptors_key"])
    return out.select("r_reviewer_source_key", "r_product_key", "review_descriptors_key")


@register("v7_in_list", O.query("""
SELECT * FROM s2_review r WHERE r.r_product_key IN (
  SELECT product_source_key FROM product_dim WHERE is_current AND sales_rank_category = 'PROMO')"""))
def v7(spark, sf):
    wh = warehouse(spark, sf)
    keys = B.current_products(wh.product.filter(F.col("sales_rank_category") == "PROMO"))
    return wh.stage2.reviews.join(keys.select(F.col("product_source_key").alias("r_product_key")),
                                  "r_product_key", "left_semi")


@register("v8_row_value_in", O.query("""
SELECT * FROM review_fact f WHERE EXISTS (
  SELECT 1 FROM s2_review r
  JOIN reviewer_dim rv ON rv.reviewer_source_key = r.r_reviewer_source_key
  JOIN product_dim p ON p.product_source_key = r.r_product_key
  WHERE r.r_review_score >= 4 AND rv.reviewer_key = f.reviewer_key AND p.product_key = f.product_key)"""))
def v8(spark, sf):
    wh = warehouse(spark, sf)
    pairs = (wh.stage2.reviews.filter(F.col("r_review_score") >= 4)
             .join(wh.reviewer, F.col("r_reviewer_source_key") == F.col("reviewer_source_key"))
             .join(wh.product, F.col("r_product_key") == F.col("product_source_key"))
             .select("reviewer_key", "product_key"))
    return wh.fact.join(pairs, ["reviewer_key", "product_key"], "left_semi")


# Scalar functions over whole tables ------------------------------------------------------

@register("p1_default_replace", O.query("""
SELECT _c0 AS source_row_id,
  CASE WHEN reviewText IS NULL OR reviewText = '' THEN '*Unknown review text' ELSE reviewText END AS review_text,
  CASE WHEN summary IS NULL OR summary = '' THEN '*Unknown review title' ELSE summary END AS review_title
FROM raw_reviews"""))
def p1(spark, sf):
    r = S.raw_reviews(spark, sf)
    return r.select(F.col("_c0").alias("source_row_id"),
                    T.default_if_blank("reviewText", T.REVIEW_DEFAULTS["review_text"]).alias("review_text"),
                    T.default_if_blank("summary", T.REVIEW_DEFAULTS["review_title"]).alias("review_title"))


@register("p2_sanitize_string", f"SELECT doc_id, {O.sanitize('text')} AS clean_text FROM documents")
def p2(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.sanitize_string("text").alias("clean_text"))


@register("p2_sanitize_conversations", f"SELECT conv_id, turn, {O.sanitize('text')} AS clean_text FROM conversations")
def p2c(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", T.sanitize_string("text").alias("clean_text"))


def _restore_sql(x: str) -> str:
    for old, new in O.TOKENS:
        x = f"replace({x}, {O.lit(new)}, {O.lit(old)})"
    return x


@register("p3_restore_string", f"SELECT doc_id, {_restore_sql(O.sanitize('text'))} AS restored FROM documents")
def p3(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", T.restore_string(T.sanitize_string("text")).alias("restored"))


@register("p4_trim_title", O.query(f" SELECT _c0 AS source_row_id, {O.strip('summary')} AS title FROM raw_reviews"))
def p4(spark, sf):
    return S.raw_reviews(spark, sf).select(F.col("_c0").alias("source_row_id"), T.py_strip("summary").alias("title"))


@register("p5_parse_literal", """SELECT event_id,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def p5(spark, sf):
    ev = L.with_literal(table(spark, sf, "events"), "props", "_p", "map<string,int>", ("dict",))
    return ev.select("event_id", F.col("_p")["k"].alias("k"))


@register("p5_python_shapes", """SELECT o_orderkey,
  'O''' || o_orderstatus || '|' || o_orderpriority || '|None|' || CAST(o_custkey AS VARCHAR) || '|True' AS leaves, 'list' AS leaves_kind,
  CAST(o_custkey AS BIGINT) AS pair_first, CASE WHEN o_orderstatus = 'F' THEN CAST(NULL AS BIGINT) ELSE CAST(-3 AS BIGINT) END AS pair_second,
  'tuple' AS pair_kind, 7 AS last_n, 2 AS entries, 'dict' AS entries_kind FROM orders""")
def p5_shapes(spark, sf):
    """Ragged lists, ``None``, ``True``, escapes, tuples, trailing commas and repeated keys."""
    key = F.col("o_custkey").cast("string")
    cells = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("['O\\'"), "o_orderstatus", F.lit("', [\""), "o_orderpriority", F.lit('", [None, '), key, F.lit("]], True,]")).alias("ragged"),
        F.concat(F.lit("("), key, F.when(F.col("o_orderstatus") == "F", ", None,)").otherwise(", -3)")).alias("pair"),
        F.concat(F.lit("{'"), "o_orderpriority", F.lit("': None, \"n\": "), key, F.lit(", 'n': 7,}")).alias("dict"))
    df = L.with_category_list(cells, "ragged", "_l")
    df = L.with_literal(df, "pair", "_p", "array<double>", ("list", "tuple"))
    df = L.with_literal(df, "dict", "_d", "map<string,int>", ("dict",))
    return df.select("o_orderkey", F.array_join("_l", "|").alias("leaves"), F.col("_l_kind").alias("leaves_kind"),
                     F.get(F.col("_p"), 0).cast("long").alias("pair_first"), F.get(F.col("_p"), 1).cast("long").alias("pair_second"),
                     F.col("_p_kind").alias("pair_kind"), F.col("_d")["n"].alias("last_n"), F.size("_d").alias("entries"),
                     F.col("_d_kind").alias("entries_kind"))


@register("p6_first_map_entry", O.query("""
SELECT asin AS product_source_key, regexp_extract(salesrank, '^\\{''([^'']*)''', 1) AS rank_category,
  CAST(regexp_extract(salesrank, ': (-?[0-9]+)\\}$', 1) AS INTEGER) AS rank FROM raw_products""",
    late_products=True))
def p6(spark, sf):
    df = L.with_literal(S.raw_products(spark, sf, late=True), "salesrank", "_sr", "map<string,int>", ("dict",))
    e = L.first_map_entry("_sr")
    return df.select(F.col("asin").alias("product_source_key"), e["key"].alias("rank_category"),
                     e["value"].alias("rank"))


@register("p7_ratio_round", O.query(" SELECT _c0 AS source_row_id, r_helpfulness_rating AS ratio FROM rc"))
def p7(spark, sf):
    df = L.with_literal(S.raw_reviews(spark, sf), "helpful", "_h", "array<double>", ("list", "tuple"))
    a, b = F.get(F.col("_h"), 0), F.get(F.col("_h"), 1)
    return df.select(F.col("_c0").alias("source_row_id"), N.ratio_round(a, b).alias("ratio"))


@register("p9_cast_float", O.query(" SELECT _c0 AS source_row_id, TRY_CAST(overall AS DOUBLE) AS score FROM raw_reviews"))
def p9(spark, sf):
    return S.raw_reviews(spark, sf).select(F.col("_c0").alias("source_row_id"), N.py_float("overall").alias("score"))


@register("p24_case_default_cast", O.query(
    " SELECT _c0 AS source_row_id, coalesce(TRY_CAST(overall AS DOUBLE), 0.0) AS score FROM raw_reviews"))
def p24(spark, sf):
    return S.raw_reviews(spark, sf).select(F.col("_c0").alias("source_row_id"),
                                           N.or_default(N.py_float("overall"), 0.0).alias("score"))


@register("p10_epoch_to_timestamp", O.query(
    " SELECT _c0 AS source_row_id, make_timestamp(TRY_CAST(unixReviewTime AS BIGINT) * 1000000) AS review_datetime"
    " FROM raw_reviews"))
def p10(spark, sf):
    return S.raw_reviews(spark, sf).select(F.col("_c0").alias("source_row_id"),
                                           N.epoch_to_timestamp("unixReviewTime").alias("review_datetime"))


@register("p11_date_key", f"SELECT o_orderkey, {O.date_key('o_orderdate')} AS date_key FROM orders")
def p11(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", D.date_key("o_orderdate").alias("date_key"))


@register("p12_date_parts", f"""SELECT DISTINCT {O.date_columns('CAST(o_orderdate AS DATE)')} FROM orders""")
def p12(spark, sf):
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return Dm._date_attrs(o)


@register("p13_date_description", """SELECT o_orderkey,
  strftime(CAST(o_orderdate AS DATE), '%A, %-d %B %Y') AS date_description FROM orders""")
def p13(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", D.date_description("o_orderdate").alias("date_description"))


@register("p14_generate_series", f"""SELECT {O.date_columns('d')} FROM (
  SELECT unnest(generate_series(date_trunc('year', min(o_orderdate))::DATE,
    (date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE, INTERVAL 1 DAY))::DATE AS d
  FROM orders)""")
def p14(spark, sf):
    return Dm.date_dim_covering(table(spark, sf, "orders"), "o_orderdate")


@register("p15_interval_arith", """SELECT o_orderkey,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 YEAR AS DATE) AS cutoff FROM orders""")
def p15(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", D.add_years("o_orderdate", 30).alias("cutoff"))


@register("p18_flatten_nested", O.query("""
SELECT asin AS product_source_key,
  array_to_string(flatten(from_json(replace(categories, '''', '"'), '[["VARCHAR"]]')), '|') AS categories
FROM raw_products""", late_products=True))
def p18(spark, sf):
    df = L.with_category_list(S.raw_products(spark, sf, late=True), "categories", "_c")
    return df.select(F.col("asin").alias("product_source_key"), F.array_join("_c", "|").alias("categories"))


@register("p21_unnest", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def p21(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@register("v1_length_rules", O.query("""
SELECT p_product_source_key AS product_source_key,
  length(p_product_metadata_id) > 7 AS metadata_id_too_long, length(p_image_url) > 225 AS image_url_too_long,
  length(p_brand) > 150 AS brand_too_long, length(p_description) > 60 AS description_over_60
FROM s1_product"""))
def v1(spark, sf):
    p = warehouse(spark, sf).stage1.products
    return p.select(F.col("p_product_source_key").alias("product_source_key"),
                    V.too_long("p_product_metadata_id", 7).alias("metadata_id_too_long"),
                    V.too_long("p_image_url", 225).alias("image_url_too_long"),
                    V.too_long("p_brand", 150).alias("brand_too_long"),
                    V.too_long("p_description", 60).alias("description_over_60"))


@register("l1_surrogate_key", """SELECT (SELECT max(c_custkey) FROM customer)
  + row_number() OVER (ORDER BY o_orderkey) AS order_sk, o_orderkey FROM orders""")
def l1(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    base = K.max_key(table(spark, sf, "customer"), "c_custkey")
    return K.assign_surrogate_keys(o, ["o_orderkey"], "order_sk", start_after=base).select("order_sk", "o_orderkey")


@register("t3_page", " SELECT * FROM (SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25 OFFSET 10)")
def t3(spark, sf):
    """A page of orders in a stated order (paging is the feature)."""
    return U.page(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 25, 10)


# Sources and sinks -----------------------------------------------------------------------

def _scratch(spark, name):
    from ..session import scratch_path
    return scratch_path(spark, name)


@register("s1_csv_scan", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def s1(spark, sf):
    """Documents written as CSV (quotes, commas, newlines in text) and scanned back."""
    from ..sources import csv as C
    path = _scratch(spark, "docs_csv")
    C.write_csv(table(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    good, _ = C.split_malformed(C.csv_scan(spark, path), "documents")
    return good


@register("s1_csv_scan_by_name", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source AS _c0 FROM documents")
def s1_by_name(spark, sf):
    """Documents in files of two header orders, one column unnamed, read by name."""
    from ..sources import csv as C
    path, docs = _scratch(spark, "docs_orders"), table(spark, sf, "documents")
    one, two = ["source", "text", "doc_id", "lang"], ["lang", "doc_id", "source", "text"]
    for part, (columns, which) in enumerate(((one, F.length("text") % 2 == 0), (two, F.length("text") % 2 == 1))):
        names = ["" if c == "source" else c for c in columns]
        C.write_csv(docs.filter(which).select(*columns).toDF(*names), f"{path}/part{part}")
    good, _ = C.split_malformed(C.csv_scan(spark, f"{path}/*"), "documents")
    return good


@register("s2_malformed_row_split", """SELECT 'orders' AS entity, 'malformed record' AS reason,
  CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) AS row
FROM orders WHERE o_orderstatus = 'P'""")
def s2q(spark, sf):
    """Order lines missing their last field (status 'P') are quarantined as malformed."""
    from ..sources import csv as C
    path = _scratch(spark, "orders_lines")
    o = table(spark, sf, "orders")
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                       F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))
    o.select(line.alias("value")).write.mode("overwrite").text(path)
    scan = C.csv_scan(spark, path, columns=["orderkey", "custkey", "priority"], multi_line=False, header=False)
    parsed = _scratch(spark, "orders_parsed")
    scan.write.mode("overwrite").parquet(parsed)   # parse once; the corrupt column is then a plain column
    return C.split_malformed(spark.read.parquet(parsed), "orders")[1]


@register("s3_table_scan", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def s3(spark, sf):
    from ..sources import sinks
    return sinks.table_scan(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderdate"])


@register("s4_bulk_append", O.query(" SELECT * FROM s1_review"))
def s4(spark, sf):
    from ..sources import sinks
    path = _scratch(spark, "s1_review")
    sinks.bulk_append(warehouse(spark, sf).stage1.reviews, path)
    return spark.read.parquet(path)


@register("s5_row_insert", O.query(" SELECT * FROM s2_product"))
def s5(spark, sf):
    from ..sources import sinks
    wh = warehouse(spark, sf)
    kept, _ = St.stage2_products(wh.stage1.products)
    path = _scratch(spark, "s2_product")
    sinks.bulk_append(kept, path)
    sinks.bulk_append(wh.stage2.placeholders, path)
    return spark.read.parquet(path)


@register("s9_to_json_rows", O.query(""" SELECT r_reviewer_source_key, r_product_key,
  strftime(r_review_datetime, '%Y-%m-%dT%H:%M:%S') AS review_datetime_iso FROM s2_review"""))
def s9(spark, sf):
    from ..sources import sinks
    js = sinks.to_json_rows(warehouse(spark, sf).stage2.reviews)
    return js.select(*[F.get_json_object("json", f"$.{c}").alias(n) for c, n in (
        ("r_reviewer_source_key", "r_reviewer_source_key"), ("r_product_key", "r_product_key"),
        ("r_review_datetime", "review_datetime_iso"))])


@register("s10_csv_to_json_keyed", O.query(""" SELECT reviewerID AS key,
  arg_max(asin, struct_pack(o := CAST(_c0 AS BIGINT), a := asin)) AS last_asin FROM raw_reviews
  GROUP BY reviewerID"""))
def s10(spark, sf):
    """Rows keyed by reviewer; the last row in file order (the index column) wins.

    The stand-in's index repeats for a few line items, so the product key
    breaks those ties.
    """
    from ..sources import sinks
    r = S.raw_reviews(spark, sf).withColumn("_order", F.struct(F.col("_c0").cast("bigint"), F.col("asin")))
    keyed = sinks.keyed_last_wins(r, "reviewerID", "_order")
    return keyed.select(F.col("reviewerID").alias("key"), F.get_json_object("json", "$.asin").alias("last_asin"))


def _kind_sql(x: str) -> str:
    """Python's type name of a cell under the typing rule, ``x`` being the stripped cell."""
    return (f"CASE WHEN NOT coalesce(json_valid({x}), false) THEN CASE WHEN regexp_full_match({x}, '[0-9]+') THEN 'int' "
            f"WHEN regexp_full_match({x}, '[0-9]+[.][0-9]*|[.][0-9]+') THEN 'float' ELSE 'str' END "
            f"ELSE CASE json_type({x}) WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str' "
            f"WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'NoneType' WHEN 'DOUBLE' THEN 'float' ELSE 'int' END END")


JSON_CELLS = ["_c0", *St.REVIEW_SOURCE_COLUMNS]


@register("s11_csv_to_json_typed", O.query(" SELECT " + ", ".join(
    f"{x} AS {c}, {_kind_sql(x)} AS {c}_kind" for c, x in (
        (c, f"replace({O.strip(f'coalesce({c}, chr(32))')}, ', ', ',')" if c == "helpful" else O.strip(f"coalesce({c}, chr(32))"))
        for c in JSON_CELLS)) + " FROM raw_reviews"))
def s11(spark, sf):
    """All reviews from CSV to JSON lines, each cell typed; read back with the JSON type of every cell."""
    from ..sources import csv as C
    from ..sources import sinks
    source, target = _scratch(spark, "s11_csv"), _scratch(spark, "s11_json")
    with finished_shuffles_removed(spark):
        C.write_csv(S.raw_reviews(spark, sf), source, compression="gzip")
        sinks.csv_to_json(spark, source, target, compression="gzip")
    lines = spark.read.text(target)
    cells = lines.select("value", F.from_json("value", ", ".join(f"`{c}` string" for c in JSON_CELLS)).alias("r"))

    def kind(c):  # a quote inside a JSON text is escaped, so the quoted name with its colon is the cell itself
        starts = [F.col("value").contains(f'"{c}":{x}') for x in ('"', "[", "{", "n")]
        number = F.when(F.col(f"r.{c}").rlike("[.eE]"), "float").otherwise("int")
        bool_ = F.col(f"r.{c}").isin("true", "false")
        return (F.when(starts[0], "str").when(starts[1], "list").when(starts[2], "dict").when(starts[3], "NoneType")
                .when(bool_, "bool").otherwise(number))
    return cells.select(*[x for c in JSON_CELLS for x in (F.col(f"r.{c}").alias(c), kind(c).alias(f"{c}_kind"))])


@register("p8_infer_scalar", f"""SELECT event_id, {_kind_sql("value::VARCHAR")} AS value_kind, value::DOUBLE AS value,
  {_kind_sql(O.strip("props"))} AS props_kind, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k,
  {_kind_sql(O.strip("event_id::VARCHAR"))} AS id_kind FROM events""")
def p8(spark, sf):
    """The event cells typed by the notebook's rule: Python type names, and values read from the typed cells."""
    from ..functions.infer import cell_kind, infer_scalar
    ev = table(spark, sf, "events").select(
        "event_id", *[infer_scalar(F.col(c).cast("string")).alias(f"_{c}") for c in ("value", "props", "event_id")])
    return ev.select("event_id", cell_kind("_value").alias("value_kind"),
                     F.try_variant_get("_value", "$", "double").alias("value"), cell_kind("_props").alias("props_kind"),
                     F.try_variant_get("_props", "$.k", "bigint").alias("props_k"), cell_kind("_event_id").alias("id_kind"))


@register("s12_csv_dump", O.query(" SELECT * FROM s2_product_category"))
def s12(spark, sf):
    from ..sources import csv as C
    path = _scratch(spark, "category_dump")
    C.csv_dump(warehouse(spark, sf).stage2.categories, path)
    good, _ = C.split_malformed(C.csv_scan(spark, path, columns=list(St.S1_CATEGORY_COLUMNS), header=False),
                                "dump")
    return good


@register("k2_not_null_key", O.query(""" SELECT 's1_review' AS table_name,
  count(*) FILTER (WHERE r_reviewer_source_key IS NULL OR r_product_key IS NULL) AS null_keys FROM s1_review
UNION ALL SELECT 's1_product', count(*) FILTER (WHERE p_product_source_key IS NULL) FROM s1_product"""))
def k2(spark, sf):
    wh = warehouse(spark, sf)
    r = wh.stage1.reviews.agg(F.count(F.when(F.col("r_reviewer_source_key").isNull()
                                            | F.col("r_product_key").isNull(), 1)).alias("null_keys"))
    p = wh.stage1.products.agg(F.count(F.when(F.col("p_product_source_key").isNull(), 1)).alias("null_keys"))
    return (r.select(F.lit("s1_review").alias("table_name"), "null_keys")
            .unionByName(p.select(F.lit("s1_product").alias("table_name"), "null_keys")))


@register("k2_missing_key_rejects", O.query(""" SELECT _c0 AS source_row_id, reviewText IS NULL OR summary IS NULL AS rejected,
  CASE WHEN reviewText IS NULL OR summary IS NULL THEN 'missing key' END AS reason FROM raw_reviews"""))
def k2_rejects(spark, sf):
    """The key rule on (text, title) before defaults: reviews without a text are rejected."""
    kept, bad = K.not_null_key(S.raw_reviews(spark, sf), ["reviewText", "summary"])
    return (kept.select(F.col("_c0").alias("source_row_id"), F.lit(False).alias("rejected"), F.lit(None).cast("string").alias("reason"))
            .unionByName(bad.select(F.col("_c0").alias("source_row_id"), F.lit(True).alias("rejected"), F.col(V.REASON).alias("reason"))))


@register("l11_unknown_member", O.query(""" SELECT * FROM reviewer_dim
UNION ALL SELECT -1, '*Unknown', '*Unknown username'"""))
def l11(spark, sf):
    wh = warehouse(spark, sf)
    return wh.reviewer.unionByName(Dm.unknown_reviewer_member(spark))


# Audit log -------------------------------------------------------------------------------

def audit_log(spark: SparkSession, sf: str) -> DataFrame:
    """An event log whose rows are the test tables' own: months of orders as batches, their
    priorities as processes, the line numbers in those as tasks.

    Everything starts at its first date.  The newest order or line tells how it ended: an
    open one (``O``) has no end event, a pending order aborts, a returned line fails its task.
    Counts are those of the lines, returned ones failed.
    """
    from ..operators import audit as A

    o = table(spark, sf, "orders").withColumn("_b", F.year("o_orderdate") * 100 + F.month("o_orderdate")) \
        .withColumn("_p", F.col("_b") * 10 + F.substring("o_orderpriority", 1, 1).cast("int"))
    lines = table(spark, sf, "lineitem").join(o.select("o_orderkey", "_p"), F.col("l_orderkey") == F.col("o_orderkey")) \
        .withColumn("_t", F.col("_p") * 10 + F.col("l_linenumber"))

    def spans(rows, key, date, newest, *more):
        return rows.groupBy(key).agg(F.min(date).alias("s"), F.max(F.struct(date, *newest)).alias("n"), *more)

    def both(g, level, key, parent, text, end, year=None, month=None, counts=None, message=None):
        common = (F.col(key), parent, text)
        closed = g.filter(F.col(f"n.{end[0]}") != "O")
        return A.events(g, level, *common, F.lit(A.RUNNING), F.col("s"), F.lit(1), year, month).unionByName(
            A.events(closed, level, *common, end[1], F.col("n").getField(end[2]), F.lit(2), counts=counts, message=message))

    def ended(column, other, name):
        return F.when(F.col(f"n.{column}") == other, name).otherwise(A.COMPLETED)

    batches = spans(o, "_b", "o_orderdate", ["o_orderkey", "o_orderstatus"])
    processes = spans(o, "_p", "o_orderdate", ["o_orderkey", "o_orderstatus"], F.min("o_orderpriority").alias("d"))
    returned = F.count(F.when(F.col("l_returnflag") == "R", 1))
    tasks = spans(lines, "_t", "l_shipdate", ["l_orderkey", "l_linestatus", "l_returnflag"],
                  F.count(F.lit(1)).alias("i"), returned.alias("f"))
    year = F.floor(F.col("_b") / 100)
    failed = F.when(F.col("n.l_returnflag") == "R", F.lit("newest line returned"))
    return both(batches, "batch", "_b", None, F.lit("orders of a month"), ("o_orderstatus", ended("o_orderstatus", "P", A.ABORTED), "o_orderdate"),
                year, F.col("_b") % 100) \
        .unionByName(both(processes, "process", "_p", F.floor(F.col("_p") / 10), F.col("d"),
                          ("o_orderstatus", ended("o_orderstatus", "P", A.FAILED), "o_orderdate"))) \
        .unionByName(both(tasks, "task", "_t", F.floor(F.col("_t") / 10), F.concat(F.lit("line "), (F.col("_t") % 10).cast("string")),
                          ("l_linestatus", ended("l_returnflag", "R", A.FAILED), "l_shipdate"),
                          counts={"records_in": F.col("i"), "records_failed": F.col("f"), "records_out": F.col("i") - F.col("f")},
                          message=failed))


AUDIT_EVENTS = """WITH o AS (
  SELECT *, year(o_orderdate) * 100 + month(o_orderdate) AS b,
         (year(o_orderdate) * 100 + month(o_orderdate)) * 10 + CAST(substr(o_orderpriority, 1, 1) AS INT) AS p FROM orders),
bt AS (SELECT b AS id, NULL::BIGINT AS parent_id, 'orders of a month' AS description, b // 100 AS year, b % 100 AS month,
         min(o_orderdate) AS s, max(o_orderdate) AS e, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS st FROM o GROUP BY b),
pr AS (SELECT p AS id, p // 10 AS parent_id, min(o_orderpriority) AS description,
         min(o_orderdate) AS s, max(o_orderdate) AS e, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS st FROM o GROUP BY p),
tl AS (SELECT o.p * 10 + l_linenumber AS id, l.* FROM lineitem l JOIN o ON l_orderkey = o_orderkey),
tk AS (SELECT id, id // 10 AS parent_id, 'line ' || (id % 10) AS description, min(l_shipdate) AS s, max(l_shipdate) AS e,
         arg_max(l_linestatus, (l_shipdate, l_orderkey, l_linestatus, l_returnflag)) AS st,
         arg_max(l_returnflag, (l_shipdate, l_orderkey, l_linestatus, l_returnflag)) AS rf,
         count(*) AS i, count(*) FILTER (WHERE l_returnflag = 'R') AS f FROM tl GROUP BY id),
events AS (
  SELECT 'batch' AS level, id, parent_id, description, year, month, 'Running' AS status, s AS event_ts, 1 AS seq,
         NULL::BIGINT AS records_in, NULL::BIGINT AS records_failed, NULL::BIGINT AS records_out FROM bt
  UNION ALL SELECT 'batch', id, parent_id, description, NULL, NULL, CASE st WHEN 'P' THEN 'Aborted' ELSE 'Completed' END,
         e, 2, NULL, NULL, NULL FROM bt WHERE st <> 'O'
  UNION ALL SELECT 'process', id, parent_id, description, NULL, NULL, 'Running', s, 1, NULL, NULL, NULL FROM pr
  UNION ALL SELECT 'process', id, parent_id, description, NULL, NULL, CASE st WHEN 'P' THEN 'Failed' ELSE 'Completed' END,
         e, 2, NULL, NULL, NULL FROM pr WHERE st <> 'O'
  UNION ALL SELECT 'task', id, parent_id, description, NULL, NULL, 'Running', s, 1, NULL, NULL, NULL FROM tk
  UNION ALL SELECT 'task', id, parent_id, description, NULL, NULL, CASE rf WHEN 'R' THEN 'Failed' ELSE 'Completed' END,
         e, 2, i, f, i - f FROM tk WHERE st <> 'O'),
latest AS (
  SELECT level, id, max(parent_id) AS parent_id, max(year) AS year, max(month) AS month,
         min(event_ts) AS start_ts,
         arg_max(status, (event_ts, seq)) AS status, arg_max(event_ts, (event_ts, seq)) AS last_ts,
         arg_max(description, (event_ts, seq)) AS description,
         arg_max(records_in, (event_ts, seq)) AS records_in,
         arg_max(records_failed, (event_ts, seq)) AS records_failed,
         arg_max(records_out, (event_ts, seq)) AS records_out
  FROM events GROUP BY level, id),
import_batch AS (SELECT id AS ib_id, description AS ib_description, year AS ib_year, month AS ib_month,
  start_ts AS ib_start, CASE WHEN status <> 'Running' THEN last_ts END AS ib_end, status AS ib_status
  FROM latest WHERE level = 'batch'),
import_batch_process AS (SELECT id AS ibp_id, parent_id AS ib_id, description AS ib_description,
  start_ts AS ib_start, CASE WHEN status <> 'Running' THEN last_ts END AS ib_end, status AS ib_status
  FROM latest WHERE level = 'process'),
import_batch_process_task AS (SELECT id AS ibpt_id, parent_id AS ibp_id, description AS ib_description,
  start_ts AS ib_start, CASE WHEN status <> 'Running' THEN last_ts END AS ib_end, status AS ib_status,
  records_in AS ibpt_records_in, records_failed AS ibpt_records_failed, records_out AS ibpt_records_out,
  CAST(NULL AS BIGINT) AS ibpt_records_type_2, CAST(NULL AS BIGINT) AS ibpt_records_type_1,
  CAST(NULL AS BIGINT) AS ibpt_records_dim_new
  FROM latest WHERE level = 'task')
"""


def _audit(final: str) -> str:
    return AUDIT_EVENTS + final


@register("m1_start_batch", _audit(" SELECT * FROM import_batch"))
def m1(spark, sf):
    from ..operators import audit as A
    return A.import_batch(audit_log(spark, sf))


@register("m2_end_batch", _audit(" SELECT ib_id, ib_end, ib_status FROM import_batch WHERE ib_status <> 'Running'"))
def m2(spark, sf):
    from ..operators import audit as A
    return A.import_batch(audit_log(spark, sf)).filter(F.col("ib_status") != A.RUNNING) \
        .select("ib_id", "ib_end", "ib_status")


@register("m3_start_end_process", _audit(" SELECT * FROM import_batch_process"))
def m3(spark, sf):
    from ..operators import audit as A
    return A.import_batch_process(audit_log(spark, sf))


@register("m4_start_end_task", _audit(" SELECT * FROM import_batch_process_task"))
def m4(spark, sf):
    from ..operators import audit as A
    return A.import_batch_process_task(audit_log(spark, sf))


@register("a5_load_counts", _audit(""" SELECT ibpt_id, ibpt_records_in, ibpt_records_failed, ibpt_records_out
FROM import_batch_process_task WHERE ib_status = 'Completed'"""))
def a5(spark, sf):
    from ..operators import audit as A
    t = A.import_batch_process_task(audit_log(spark, sf)).filter(F.col("ib_status") == A.COMPLETED)
    return t.select("ibpt_id", "ibpt_records_in", "ibpt_records_failed", "ibpt_records_out")


@register("m5_record_failure", _audit(""" SELECT level, id, 'Failed' AS status FROM (
  SELECT level, id, row_number() OVER (PARTITION BY level ORDER BY start_ts DESC, id DESC) AS rn
  FROM latest WHERE status = 'Running') WHERE rn = 1"""))
def m5(spark, sf):
    from ..operators import audit as A
    return A.record_failure(audit_log(spark, sf), "2024-02-01 00:05:00", 4, "task failed").select(
        "level", "id", "status")


@register("s8_error_log_sink", _audit(""" SELECT level AS entity, id, 'task failed' AS message FROM (
  SELECT level, id, row_number() OVER (PARTITION BY level ORDER BY start_ts DESC, id DESC) AS rn
  FROM latest WHERE status = 'Running') WHERE rn = 1 AND level = 'task'"""))
def s8(spark, sf):
    """A failed task's error row: the newest running task is marked Failed with its message."""
    from ..operators import audit as A
    ev = A.record_failure(audit_log(spark, sf), "2024-02-01 00:05:00", 4, "task failed")
    return ev.filter(F.col("level") == "task").select(F.col("level").alias("entity"), "id", "message")


@register("m6_latest_running_batch", _audit(""" SELECT ib_id FROM import_batch WHERE ib_status = 'Running'
ORDER BY ib_start DESC, ib_id DESC LIMIT 1"""))
def m6(spark, sf):
    from ..operators import audit as A
    return A.latest_running_batch(audit_log(spark, sf))


@register("t2_top1_latest", _audit(""" SELECT ibpt_id, ib_start FROM import_batch_process_task
ORDER BY ib_start DESC, ibpt_id DESC LIMIT 1"""))
def t2(spark, sf):
    from ..operators import audit as A
    t = A.import_batch_process_task(audit_log(spark, sf))
    return t.orderBy(F.col("ib_start").desc(), F.col("ibpt_id").desc()).limit(1).select("ibpt_id", "ib_start")


@register("m7_status_set", _audit(" SELECT level, status, count(*) AS n FROM latest GROUP BY level, status"))
def m7(spark, sf):
    from ..operators import audit as A
    return A.latest_state(audit_log(spark, sf)).groupBy("level", "status").agg(F.count(F.lit(1)).alias("n"))


@register("v10_status_filter", _audit(" SELECT ib_id, ib_status FROM import_batch WHERE ib_status = 'Running'"))
def v10(spark, sf):
    from ..operators import audit as A
    return A.import_batch(audit_log(spark, sf)).filter(F.col("ib_status") == A.RUNNING).select("ib_id", "ib_status")


@register("a4_max_scalar", _audit(" SELECT max(ib_id) AS max_ib_id FROM import_batch"))
def a4(spark, sf):
    from ..operators import audit as A
    return A.import_batch(audit_log(spark, sf)).agg(F.max("ib_id").alias("max_ib_id"))


@register("v11_latest_equals_max", _audit(""" SELECT * FROM import_batch
WHERE ib_id = (SELECT max(ib_id) FROM import_batch)"""))
def v11(spark, sf):
    from ..operators import audit as A
    b = A.import_batch(audit_log(spark, sf))
    return b.join(F.broadcast(b.agg(F.max("ib_id").alias("ib_id"))), "ib_id")


@register("q3_import_statistics", _audit(""" SELECT t.*, p.ib_id, p.ib_description AS process_description,
  p.ib_status AS process_status, b.ib_description AS batch_description, b.ib_status AS batch_status
FROM import_batch_process_task t JOIN import_batch_process p ON t.ibp_id = p.ibp_id
JOIN import_batch b ON p.ib_id = b.ib_id WHERE b.ib_id = (SELECT max(ib_id) FROM import_batch)"""))
def q3(spark, sf):
    from ..operators import audit as A
    return A.import_statistics(audit_log(spark, sf))


@register("j9_audit_join", _audit(""" SELECT t.ibpt_id, t.ib_description, p.ibp_id, p.ib_id
FROM import_batch_process_task t JOIN import_batch_process p ON t.ibp_id = p.ibp_id"""))
def j9(spark, sf):
    from ..operators import audit as A
    log = audit_log(spark, sf)
    t = A.import_batch_process_task(log)
    p = A.import_batch_process(log).select("ibp_id", "ib_id")
    return t.join(p, "ibp_id").select("ibpt_id", "ib_description", "ibp_id", "ib_id")


# The persisted pipeline over three batches: partial file, complete file, partial file of the same state ----

def three_batches(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Tables stored by ``run_pipeline`` after three batches over CSV files of the stand-in."""
    from ..sources.csv import write_csv
    from . import pipeline as P

    def build():
        reviews, partial, complete, again = (_scratch(spark, n) for n in ("b_reviews", "b_partial", "b_complete", "b_again"))
        write_csv(S.raw_reviews(spark, sf), reviews, compression="gzip")
        write_csv(S.raw_products(spark, sf), partial, compression="gzip")
        write_csv(S.raw_products(spark, sf, late=True), complete, compression="gzip")
        write_csv(S.raw_products(spark, sf, repriced=True), again, compression="gzip")
        root = _scratch(spark, "b_warehouse")
        for as_of, products in ((AS_OF_1, partial), (AS_OF_2, complete), (AS_OF_3, again)):
            P.run_pipeline(spark, reviews, products, P.RunConfig(root=root, as_of=as_of, date_start="1990-01-01", date_years=40))
        return P.warehouse_tables(spark, root)
    with finished_shuffles_removed(spark):
        return _memo(("batches", spark.sparkContext.applicationId, sf), build)


@register("pipeline_three_batches_fact", O.query(" SELECT * FROM review_fact"))
def batches_fact(spark, sf):
    """No batch after the first adds a fact: neither new versions nor placeholders make a review another one."""
    from ..operators.fact import FACT_COLUMNS
    return three_batches(spark, sf)["review_fact"].select(*FACT_COLUMNS)


@register("pipeline_three_batches_product_dim", O.query(PRODUCT_DIM_2 + " SELECT * FROM product_dim_2"))
def batches_product_dim(spark, sf):
    """The complete file replaces placeholders; the partial file after it changes nothing."""
    return three_batches(spark, sf)["product"]


@register("pipeline_three_batches_reviewer", O.query(""" SELECT * FROM reviewer_dim
UNION ALL SELECT -1, '*Unknown', '*Unknown username'"""))
def batches_reviewer(spark, sf):
    """The unknown reviewer is a member from the first batch on and takes no key of others."""
    return three_batches(spark, sf)["reviewer"]


@register("pipeline_three_batches_date", O.query(f""", loaded AS (
  SELECT unnest(generate_series(DATE '1990-01-01', DATE '2030-01-01', INTERVAL 1 DAY))::DATE AS d),
days AS (SELECT {O.date_columns('d')} FROM loaded UNION ALL
  SELECT 19000101, DATE '1900-01-01', 'Monday', 'January', 1, 1, 1900, 1, '*Unknown Date'),
per_day AS (SELECT date_reviewed_key, count(*) AS n_reviews FROM review_fact GROUP BY 1)
SELECT days.*, coalesce(n_reviews, 0) AS n_reviews FROM days LEFT JOIN per_day ON date_key = date_reviewed_key"""))
def batches_date(spark, sf):
    """The stored date dimension, its unknown member included, with the reviews of each day."""
    w = three_batches(spark, sf)
    per_day = w["review_fact"].groupBy(F.col("date_reviewed_key").alias("date_key")).agg(F.count(F.lit(1)).alias("n_reviews"))
    return w["date"].join(per_day, "date_key", "left").na.fill(0, ["n_reviews"])


@register("pipeline_three_batches_q1", O.query("""
SELECT c.product_category, d.year, d.month_of_year, AVG(f.review_rating) AS avg_review_rating
FROM review_fact f JOIN product_dim p ON f.product_key = p.product_key
JOIN bridge_dim b ON p.product_key = b.product_key JOIN category_dim c ON b.category_key = c.category_key
JOIN date_dim d ON f.date_reviewed_key = d.date_key
GROUP BY c.product_category, d.year, d.month_of_year"""))
def batches_q1(spark, sf):
    w = three_batches(spark, sf)
    return star.rating_per_category_per_month(w["review_fact"], w["product"], w["product_category_bridge"], w["category"], w["date"])


@register("pipeline_three_batches_q2", O.query("""
SELECT p.brand, d.year, d.month_of_year, AVG(f.review_rating) AS avg_review_rating
FROM review_fact f JOIN product_dim p ON f.product_key = p.product_key
JOIN date_dim d ON f.date_reviewed_key = d.date_key
GROUP BY p.brand, d.year, d.month_of_year"""))
def batches_q2(spark, sf):
    w = three_batches(spark, sf)
    return star.rating_per_brand_per_month(w["review_fact"], w["product"], w["date"])


# Rules exercised on long texts, streaming ingest, batch clock parts ---------------------------

@register("v3_category_rules", """SELECT CAST(doc_id AS VARCHAR) AS product_source_key,
  1 + CASE WHEN length(text) <= 150 THEN 1 ELSE 0 END AS n_kept,
  CASE WHEN length(text) > 150 THEN 1 ELSE 0 END AS n_too_long FROM documents""")
def v3(spark, sf):
    """Each document becomes a product whose categories are [[lang, whole text]]: texts over
    150 characters are rejected as ``category too long``, the language is kept."""
    d = table(spark, sf, "documents")
    raw = d.select(F.col("doc_id").cast("string").alias("metadataid"), F.col("doc_id").cast("string").alias("asin"),
                   F.lit(None).cast("string").alias("salesrank"), F.lit(None).cast("string").alias("imurl"),
                   F.to_json(F.array(F.array("lang", "text"))).alias("categories"),
                   F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("description"),
                   F.lit(None).cast("string").alias("price"), F.lit(None).cast("string").alias("related"),
                   F.lit(None).cast("string").alias("brand"))
    po = St.product_outputs(St.classify_products(raw))
    kept = po.categories.groupBy(F.col("pc_product_source_key").alias("product_source_key")) \
        .agg(F.count(F.lit(1)).alias("n_kept"))
    long_ = (po.rejects.filter(F.col("reason") == V.REASONS["category"])
             .groupBy(F.get_json_object("row", "$.asin").alias("product_source_key"))
             .agg(F.count(F.lit(1)).alias("n_too_long")))
    return (kept.join(long_, "product_source_key", "full")
            .select("product_source_key", F.coalesce("n_kept", F.lit(0)).alias("n_kept"),
                    F.coalesce("n_too_long", F.lit(0)).alias("n_too_long")))


@register("v4_relation_rules", """SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS product_source_key,
  CASE WHEN length(text) <= 10 AND length(role) <= 20 THEN 1 ELSE 0 END AS n_kept,
  CASE WHEN length(text) <= 10 AND length(role) <= 20 THEN 0 ELSE 1 END AS n_too_long
FROM conversations""")
def v4(spark, sf):
    """Each conversation turn becomes a product related to its whole text under its role:
    keys over 10 characters (or relations over 20) are rejected, the rest kept."""
    c = table(spark, sf, "conversations")
    key = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    raw = c.select(F.lit("m").alias("metadataid"), key.alias("asin"), F.lit(None).cast("string").alias("salesrank"),
                   F.lit(None).cast("string").alias("imurl"), F.lit("[]").alias("categories"),
                   F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("description"),
                   F.lit(None).cast("string").alias("price"),
                   F.to_json(F.create_map("role", F.array("text"))).alias("related"),
                   F.lit(None).cast("string").alias("brand"))
    po = St.product_outputs(St.classify_products(raw))
    kept = po.related.groupBy(F.col("rl_product_source_key").alias("product_source_key")) \
        .agg(F.count(F.lit(1)).alias("n_kept"))
    long_ = (po.rejects.filter(F.col("reason") == V.REASONS["related"])
             .groupBy(F.get_json_object("row", "$.asin").alias("product_source_key"))
             .agg(F.count(F.lit(1)).alias("n_too_long")))
    all_keys = po.products.select(F.col("p_product_source_key").alias("product_source_key"))
    return (all_keys.join(kept, "product_source_key", "left").join(long_, "product_source_key", "left")
            .select("product_source_key", F.coalesce("n_kept", F.lit(0)).alias("n_kept"),
                    F.coalesce("n_too_long", F.lit(0)).alias("n_too_long")))


@register("p23_now_parts", _audit(" SELECT ib_id, ib_year, ib_month FROM import_batch"))
def p23(spark, sf):
    """Batch year and month are data given to the batch, not read from a clock."""
    from ..operators import audit as A
    return A.import_batch(audit_log(spark, sf)).select("ib_id", "ib_year", "ib_month")


@register("streaming_stage1_ingest", O.query(""" SELECT * EXCLUDE (_c0, r_helpfulness_rating),
  CASE WHEN reject_reason IS NULL THEN r_helpfulness_rating END AS r_helpfulness_rating FROM rc"""))
def stream_ingest(spark, sf):
    """Review CSV files dropped in a folder, ingested by Structured Streaming (availableNow)."""
    from ..sources.csv import write_csv
    from ..streaming.ingest import start_review_ingest
    folder, out, ck = _scratch(spark, "drop"), _scratch(spark, "stream_out"), _scratch(spark, "stream_ck")
    raw = S.raw_reviews(spark, sf)
    with finished_shuffles_removed(spark):
        write_csv(raw, folder, compression="gzip")
    q = start_review_ingest(spark, folder, raw.columns, out, ck)
    q.awaitTermination()
    return spark.read.parquet(out).select(*St.S1_REVIEW_COLUMNS, V.REASON)


@register("streaming_ingest_by_name", O.query(""" SELECT * EXCLUDE (_c0, r_helpfulness_rating),
  CASE WHEN reject_reason IS NULL THEN r_helpfulness_rating END AS r_helpfulness_rating FROM rc"""))
def stream_by_name(spark, sf):
    """Review files of two header orders with an unnamed index column, a few files a micro-batch."""
    from ..sources.csv import write_csv
    from ..streaming.ingest import start_review_ingest
    folder, out, ck = _scratch(spark, "drop2"), _scratch(spark, "stream2_out"), _scratch(spark, "stream2_ck")
    raw = S.raw_reviews(spark, sf)
    even = F.col("_c0").cast("long") % 2 == 0
    with finished_shuffles_removed(spark):
        for part, (columns, which) in enumerate(((raw.columns, even), (raw.columns[::-1], ~even))):
            named = raw.filter(which).select(*columns).toDF(*["" if c == "_c0" else c for c in columns])
            write_csv(named, f"{folder}/part{part}", compression="gzip")
    start_review_ingest(spark, f"{folder}/*", raw.columns, out, ck, max_files_per_trigger=3).awaitTermination()
    return spark.read.parquet(out).select(*St.S1_REVIEW_COLUMNS, V.REASON)


# Stage 2 over three batches that repeat keys, change rows and reverse edges ------------------------

def cumulative_stage2(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(reviews, rejected reviews, related edges) that three batches leave, keys and edges held in stored indexes.

    Reviews: order lines 1-3; lines 2-5, those of line 2 with another score; all
    lines.  Edges: of the early products, of all products, and all reversed.
    """
    from functools import reduce
    from ..operators import key_index as Ki
    from ..operators.joins import met_pairs

    def build():
        wh = warehouse(spark, sf)
        raw = materialize(S.raw_reviews(spark, sf))  # read by three batches
        line = F.col("_c0").cast("long") % 10
        changed = raw.withColumn("overall", F.when((line == 2) & (F.col("overall") != "n/a"), F.lit("1.0")).otherwise(F.col("overall")))
        reviews = [St.review_outputs(W.classified_reviews(r))[0] for r in
                   (raw.filter(line <= 3), changed.filter(line.between(2, 5)), raw)]
        all_edges = late_products(spark, sf).related
        back = all_edges.select(F.col("rl_related_product_source_key").alias("rl_product_source_key"),
                                F.col("rl_product_source_key").alias("rl_related_product_source_key"), "rl_relation")
        root, parts = _scratch(spark, "met"), []
        for batch, (r, e) in enumerate(zip(reviews, (wh.stage1.related, all_edges, back)), start=1):
            taken = Ki.KeyIndex(spark, f"{root}/review", St.REVIEW_KEY, 8)
            edges = Ki.KeyIndex(spark, f"{root}/related", ["_lo", "_hi"], 8)
            pairs = met_pairs(e, "rl_product_source_key", "rl_related_product_source_key")
            before = list(range(1, batch))
            new, rejected = St.stage2_reviews(r, taken.read(before, taken.touched(r)))
            related = St.stage2_related(e, met=edges.read(before, edges.touched(pairs)))
            parts.append([materialize(d.withColumn("batch", F.lit(batch))) for d in (new, rejected, related)])
            taken.write(parts[-1][0].select(*St.REVIEW_KEY, Ki.row_digest(St.S1_REVIEW_COLUMNS).alias(Ki.DIGEST)), batch)
            edges.write(pairs, batch)
        return tuple(reduce(DataFrame.unionByName, kind) for kind in zip(*parts))
    with finished_shuffles_removed(spark), compiled_methods(spark):
        return _memo(("cumulative", spark.sparkContext.applicationId, sf), build)


_PK = "r_reviewer_source_key, r_product_key"
CUMULATIVE = f""",
b AS (SELECT 1 AS batch, * EXCLUDE (_c0, reject_reason) FROM rc WHERE reject_reason IS NULL AND CAST(_c0 AS BIGINT) % 10 <= 3
  UNION SELECT 2, * EXCLUDE (_c0, reject_reason) REPLACE (CASE WHEN CAST(_c0 AS BIGINT) % 10 = 2 THEN 1.0 ELSE r_review_score END AS r_review_score)
    FROM rc WHERE reject_reason IS NULL AND CAST(_c0 AS BIGINT) % 10 BETWEEN 2 AND 5
  UNION SELECT 3, * EXCLUDE (_c0, reject_reason) FROM rc WHERE reject_reason IS NULL),
first AS (SELECT {_PK}, min(batch) AS batch FROM b GROUP BY ALL),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY {_PK} ORDER BY r_review_datetime DESC NULLS LAST, {O.nulls_first(O.REVIEW_PAYLOAD)}) AS _rn
  FROM b JOIN first USING ({_PK}, batch)),
held AS (SELECT * EXCLUDE (_rn) FROM ranked WHERE _rn = 1),
refused AS (SELECT * FROM b EXCEPT SELECT * FROM held
  EXCEPT SELECT b.* FROM b JOIN (SELECT * EXCLUDE (batch) FROM held) h ON {' AND '.join(f'b.{c} IS NOT DISTINCT FROM h.{c}' for c in St.S1_REVIEW_COLUMNS)})
"""


@register("l12_cumulative_reviews", O.query(CUMULATIVE + " SELECT * FROM held"))
def l12_reviews(spark, sf):
    """A key stays with the row of the first batch that has it; rows met again add nothing."""
    return cumulative_stage2(spark, sf)[0]


@register("l12_cumulative_rejects", O.query(CUMULATIVE + " SELECT *, 'duplicate key' AS reject_reason FROM refused"))
def l12_rejects(spark, sf):
    """Other rows of a taken key, and of a batch's own repeated keys, are rejected in each batch that has them."""
    return cumulative_stage2(spark, sf)[1]


@register("j1_reciprocal_over_batches", O.query(""",
e AS (SELECT DISTINCT 1 AS batch, * FROM s1_related_product UNION SELECT DISTINCT 2, * FROM s1_related_product_late
  UNION SELECT DISTINCT 3, rl_related_product_source_key, rl_product_source_key, rl_relation FROM s1_related_product_late)
SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM e AS o WHERE o.batch <= e.batch
  AND o.rl_product_source_key = e.rl_related_product_source_key AND o.rl_related_product_source_key = e.rl_product_source_key)"""))
def j1_batches(spark, sf):
    """An edge goes if its reverse came in its own batch or an earlier one."""
    return cumulative_stage2(spark, sf)[2]


@register("l9_fact_event_time_versions", O.query(PRODUCT_DIM_2 + """,
pv AS (SELECT product_key, product_source_key, expiration_date AS valid_to,
         CASE WHEN effective_date > min(effective_date) OVER (PARTITION BY product_source_key)
              THEN effective_date END AS valid_from FROM product_dim_2),
fr AS (
  SELECT r.r_review_date_key AS date_reviewed_key, rv.reviewer_key, pv.product_key, j.review_descriptors_key,
         CAST(r.r_helpfulness_rating AS DOUBLE) AS helpfulness_rating,
         CAST(r.r_review_score AS DOUBLE) AS review_rating
  FROM s2_review_view r
  JOIN reviewer_dim rv ON rv.reviewer_source_key = r.r_reviewer_source_key
  JOIN pv ON pv.product_source_key = r.r_product_key
         AND (pv.valid_from IS NULL OR r.r_review_datetime >= pv.valid_from)
         AND (pv.valid_to IS NULL OR r.r_review_datetime < pv.valid_to)
  JOIN junk_dim j ON j.review_text = r.r_review_text AND j.review_title = r.r_review_title
  JOIN date_dim d ON d.date_key = r.r_review_date_key)
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY date_reviewed_key, reviewer_key, product_key, review_descriptors_key
    ORDER BY review_rating DESC NULLS LAST, helpfulness_rating ASC NULLS FIRST, review_rating ASC NULLS FIRST) AS _rn
  FROM fr) WHERE _rn = 1"""))
def l9_event(spark, sf):
    """Facts bound to the product version valid at the review time (H7), against the
    two-snapshot product dimension; older reviews bind to a key's first version."""
    wh = warehouse(spark, sf)
    rows, _, _ = Fa.load_fact(St.review_view(wh.stage2.reviews), wh.reviewer, product_dim_v2(spark, sf),
                              wh.junk_keys, wh.date, product_version="event")
    return rows
