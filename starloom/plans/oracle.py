"""Independent SQL rendering of the load, for the DuckDB oracle.

This is the checking side: the same stand-in rows go through a plain SQL
version of every rule (written against the stand-in's formats), and each
registered query's final SELECT runs on top of the chain below.  DuckDB
drops CTEs a query does not reference.
"""

from __future__ import annotations

from .standin import DUCK, duck_sql, raw_products_sql, raw_reviews_sql

AS_OF = "2024-01-01 00:00:00"

# Fixed values, stated here on their own so that the oracle checks the library's:
# the sanitising replacements in order, and the characters Python counts as white space.
TOKENS = [
    ("=\\ ", "__EQ_BACKSLASH__"),
    ("\\", "__BACKSLASH__"),
    ("'", "__SINGLE_QUOTE__"),
    ('"', "__DOUBLE_QUOTE__"),
    ("\n", "__NEWLINE__"),
    ("\r", "__CARRIAGE_RETURN__"),
    ("\t", "__TAB__"),
]
SPACE = (r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def lit(s: str) -> str:
    """SQL string literal; control characters through chr()."""
    out, buf = [], ""
    for ch in s:
        if ch in "\n\r\t":
            if buf:
                out.append("'" + buf.replace("'", "''") + "'")
                buf = ""
            out.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not out:
        out.append("'" + buf.replace("'", "''") + "'")
    return " || ".join(out)


def sanitize(x: str) -> str:
    for old, new in TOKENS:
        x = f"replace({x}, {lit(old)}, {lit(new)})"
    return f"regexp_replace({x}, '{SPACE}{{2,}}', ' ', 'g')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR {x} = '')"


def clean(x: str, default: str, do_strip: bool = False) -> str:
    body = strip(x) if do_strip else x
    return f"CASE WHEN {blank(x)} THEN {lit(default)} ELSE {sanitize(body)} END"


def half_up(a: str, b: str) -> str:
    n = f"(200 * {a} + {b})"
    return (f"CASE WHEN {b} = 0 THEN NULL ELSE "
            f"CAST(({n} - ({n} % (2 * {b}))) // (2 * {b}) AS DOUBLE) / 100.0 END")


def date_key(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def date_columns(d: str) -> str:
    return f"""{date_key(d)} AS date_key, CAST({d} AS DATE) AS date,
  strftime({d}, '%A') AS day_of_week, strftime({d}, '%B') AS month_of_year,
  CAST(month({d}) AS INTEGER) AS month_of_year_number, CAST(day({d}) AS INTEGER) AS day_of_month,
  CAST(year({d}) AS INTEGER) AS year, CAST(quarter({d}) AS INTEGER) AS quarter,
  strftime({d}, '%A, %-d %B %Y') AS date_description"""


HELP_RE = r"'^\[(-?[0-9]+), (-?[0-9]+)\]$'"
RANK_RE = r"'^\{''([^'']*)'': (-?[0-9]+)\}$'"

REVIEW_PAYLOAD = ["r_reviewer_name", "r_helpfulness_rating", "r_review_text", "r_review_score",
                  "r_review_title", "r_review_datetime"]
PRODUCT_PAYLOAD = ["p_product_metadata_id", "p_sales_rank_category", "p_sales_rank", "p_image_url",
                   "p_title", "p_description", "p_price", "p_brand"]


def nulls_first(cols: list[str]) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def chain(late_products: bool = False) -> str:
    """All CTEs of the load, as one ``WITH`` list (without the keyword)."""
    q = "''"
    product_block = product_ctes("", late_products) + product_ctes("_late", True)
    return f"""
raw_reviews AS ({duck_sql(raw_reviews_sql(DUCK))}),
rc0 AS (
  SELECT *,
    CASE WHEN {blank('reviewerID')} THEN '*Unknown' ELSE reviewerID END AS _rid,
    CASE WHEN {blank('asin')} THEN '*None' ELSE asin END AS _pk,
    TRY_CAST(overall AS DOUBLE) AS _score,
    TRY_CAST(regexp_extract(helpful, {HELP_RE}, 1) AS BIGINT) AS _ha,
    TRY_CAST(regexp_extract(helpful, {HELP_RE}, 2) AS BIGINT) AS _hb,
    make_timestamp(TRY_CAST(unixReviewTime AS BIGINT) * 1000000) AS _ts
  FROM raw_reviews),
rc AS (
  SELECT _c0,
    _rid AS r_reviewer_source_key, _pk AS r_product_key,
    {sanitize("CASE WHEN " + blank('reviewerName') + " THEN '*Unknown username' ELSE reviewerName END")}
      AS r_reviewer_name,
    CASE WHEN _hb IS NOT NULL AND (_hb = 0 OR _ha IS NOT NULL) THEN {half_up('_ha', '_hb')} END
      AS r_helpfulness_rating,
    {clean('reviewText', '*Unknown review text')} AS r_review_text,
    _score AS r_review_score,
    {clean('summary', '*Unknown review title', True)} AS r_review_title,
    _ts AS r_review_datetime,
    CASE WHEN length(_rid) > 21 THEN 'reviewer_id too long'
         WHEN length(_pk) > 10 THEN 'product_key too long'
         WHEN _score IS NULL THEN 'Invalid review score'
         WHEN NOT coalesce(_hb IS NOT NULL AND (_hb = 0 OR _ha IS NOT NULL), false)
           THEN 'Invalid helpful rating'
         WHEN _ts IS NULL THEN 'Invalid review date time rating' END AS reject_reason
  FROM rc0),
s1_review AS (SELECT * EXCLUDE (_c0, reject_reason) FROM rc WHERE reject_reason IS NULL),
{product_block}s2_review AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY r_reviewer_source_key, r_product_key
                                 ORDER BY r_review_datetime DESC NULLS LAST, {nulls_first(REVIEW_PAYLOAD)}) AS _rn
    FROM s1_review) WHERE _rn = 1),
s2_product_category AS (SELECT DISTINCT * FROM s1_product_category),
s2_related_product AS (
  SELECT DISTINCT rl_product_source_key, rl_related_product_source_key, rl_relation
  FROM s1_related_product sp1
  WHERE NOT EXISTS (SELECT 1 FROM s1_related_product sp2
                    WHERE sp1.rl_product_source_key = sp2.rl_related_product_source_key
                      AND sp1.rl_related_product_source_key = sp2.rl_product_source_key)),
missing_products AS (
  SELECT k AS p_product_source_key FROM (
    SELECT r_product_key AS k FROM s2_review
    UNION SELECT pc_product_source_key FROM s2_product_category
    UNION SELECT rl_product_source_key FROM s2_related_product
    UNION SELECT rl_related_product_source_key FROM s2_related_product)
  EXCEPT SELECT p_product_source_key FROM s2_product_k),
placeholders AS (
  SELECT '*None' AS p_product_metadata_id, p_product_source_key, '*Unknown category' AS p_sales_rank_category,
         -1 AS p_sales_rank, '*Unknown URL' AS p_image_url, '*Unknown title' AS p_title,
         '*Unknown description' AS p_description, -1.0::DOUBLE AS p_price, '*Unknown brand' AS p_brand
  FROM missing_products),
s2_product AS (SELECT * FROM s2_product_k UNION ALL SELECT * FROM placeholders),
s2_review_view AS (SELECT *, {date_key('r_review_datetime')} AS r_review_date_key FROM s2_review),
date_span AS (SELECT date_trunc('year', min(r_review_datetime))::DATE AS lo,
                     (date_trunc('year', max(r_review_datetime)) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE AS hi
              FROM s2_review),
date_dim AS (SELECT {date_columns('d')} FROM (
  SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d FROM date_span)),
reviewer_latest AS (
  SELECT r_reviewer_source_key AS reviewer_source_key, r_reviewer_name AS reviewer_name FROM (
    SELECT *, row_number() OVER (PARTITION BY r_reviewer_source_key
                                 ORDER BY r_review_datetime DESC NULLS LAST, r_reviewer_name DESC) AS _rn
    FROM s2_review) WHERE _rn = 1),
reviewer_dim AS (SELECT row_number() OVER (ORDER BY reviewer_source_key) AS reviewer_key,
                        reviewer_source_key, reviewer_name FROM reviewer_latest),
product_dim AS (
  SELECT row_number() OVER (ORDER BY p_product_source_key) AS product_key,
         p_product_source_key AS product_source_key, p_product_metadata_id AS product_metadata_id,
         p_sales_rank_category AS sales_rank_category, p_sales_rank AS sales_rank,
         p_image_url AS product_image_url, p_title AS product_title, p_description AS product_description,
         p_price AS price, p_brand AS brand, TIMESTAMP '{AS_OF}' AS effective_date,
         CAST(NULL AS TIMESTAMP) AS expiration_date, true AS is_current
  FROM s2_product),
category_dim AS (SELECT row_number() OVER (ORDER BY product_category) AS category_key, product_category
                 FROM (SELECT DISTINCT pc_category AS product_category FROM s2_product_category
                       WHERE pc_category IS NOT NULL)),
bridge_dim AS (
  SELECT DISTINCT p.product_key, c.category_key
  FROM s2_product_category b
  JOIN product_dim p ON p.is_current AND p.product_source_key = b.pc_product_source_key
  JOIN category_dim c ON c.product_category = b.pc_category),
junk_pairs AS (SELECT DISTINCT r_review_text AS review_text, r_review_title AS review_title FROM s2_review),
junk_dim AS (
  SELECT row_number() OVER (ORDER BY descriptor_hash, review_text, review_title) AS review_descriptors_key,
         review_text, review_title, descriptor_hash
  FROM (SELECT *, md5(md5(review_text) || md5(review_title)) AS descriptor_hash FROM junk_pairs)),
related_dim AS (
  SELECT p1.product_key AS primary_product_key, p2.product_key AS secondary_product_key,
         min(r.rl_relation) AS relation
  FROM s2_related_product r
  JOIN product_dim p1 ON p1.is_current AND p1.product_source_key = r.rl_product_source_key
  JOIN product_dim p2 ON p2.is_current AND p2.product_source_key = r.rl_related_product_source_key
  GROUP BY 1, 2),
fact_resolved AS (
  SELECT r.r_review_date_key AS date_reviewed_key, rv.reviewer_key, p.product_key, j.review_descriptors_key,
         CAST(r.r_helpfulness_rating AS DOUBLE) AS helpfulness_rating,
         CAST(r.r_review_score AS DOUBLE) AS review_rating
  FROM s2_review_view r
  JOIN reviewer_dim rv ON rv.reviewer_source_key = r.r_reviewer_source_key
  JOIN product_dim p ON p.is_current AND p.product_source_key = r.r_product_key
  JOIN junk_dim j ON j.review_text = r.r_review_text AND j.review_title = r.r_review_title
  JOIN date_dim d ON d.date_key = r.r_review_date_key),
review_fact AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY date_reviewed_key, reviewer_key, product_key, review_descriptors_key
      ORDER BY review_rating DESC NULLS LAST, helpfulness_rating ASC NULLS FIRST,
               review_rating ASC NULLS FIRST) AS _rn
    FROM fact_resolved) WHERE _rn = 1)
"""


def product_ctes(sfx: str, late: bool) -> str:
    """Stage-1 and key-deduplicated stage-2 product CTEs, names suffixed by ``sfx``."""
    q = "''"
    return f"""raw_products{sfx} AS ({duck_sql(raw_products_sql(DUCK, late))}),
pc0{sfx} AS (
  SELECT *,
    CASE WHEN {blank('metadataid')} THEN '*None' ELSE metadataid END AS _mid,
    CASE WHEN {blank('asin')} THEN '*None' ELSE asin END AS _skey,
    CASE WHEN regexp_matches(salesrank, {RANK_RE}) THEN regexp_extract(salesrank, {RANK_RE}, 1)
         ELSE '*Unknown category' END AS _rank_cat,
    CASE WHEN regexp_matches(salesrank, {RANK_RE}) THEN CAST(regexp_extract(salesrank, {RANK_RE}, 2) AS INTEGER)
         ELSE -1 END AS _rank,
    CASE WHEN {blank('imurl')} THEN '*Unknown URL' ELSE imurl END AS _image,
    {clean('brand', '*Unknown brand')} AS _brand,
    CASE WHEN {blank('price')} THEN -1.0 ELSE TRY_CAST(price AS DOUBLE) END AS _price,
    CASE WHEN starts_with(categories, '[') THEN flatten(from_json(replace(categories, '{q}', '"'), '[["VARCHAR"]]')) END AS _cats,
    from_json(replace(related, '{q}', '"'), '{{"also_bought": ["VARCHAR"], "also_viewed": ["VARCHAR"]}}') AS _rel
  FROM raw_products{sfx}),
pc{sfx} AS (
  SELECT _mid AS p_product_metadata_id, _skey AS p_product_source_key,
    _rank_cat AS p_sales_rank_category, _rank AS p_sales_rank, _image AS p_image_url,
    {clean('title', '*Unknown title')} AS p_title,
    {clean('description', '*Unknown description')} AS p_description,
    _price AS p_price, _brand AS p_brand, _cats, _rel,
    CASE WHEN _price IS NULL THEN 'invalid price'
         WHEN length(_mid) > 7 THEN 'product_metadata_id too long'
         WHEN length(_skey) > 10 THEN 'product_source_key too long'
         WHEN length(_rank_cat) > 50 THEN 'sales_rank_category too long'
         WHEN length(_image) > 225 THEN 'image_url too long'
         WHEN length(_brand) > 150 THEN 'brand too long' END AS reject_reason
  FROM pc0{sfx}),
s1_product{sfx} AS (SELECT * EXCLUDE (_cats, _rel, reject_reason) FROM pc{sfx} WHERE reject_reason IS NULL),
s1_cat_all{sfx} AS (SELECT p_product_source_key AS pc_product_source_key, unnest(_cats) AS pc_category
               FROM pc{sfx} WHERE reject_reason IS NULL AND _cats IS NOT NULL),
s1_product_category{sfx} AS (SELECT * FROM s1_cat_all{sfx} WHERE length(pc_category) <= 150),
s1_rel_all{sfx} AS (
  SELECT p_product_source_key AS rl_product_source_key, unnest(_rel.also_bought) AS rl_related_product_source_key,
         'also_bought' AS rl_relation FROM pc{sfx} WHERE reject_reason IS NULL AND _cats IS NOT NULL
  UNION ALL
  SELECT p_product_source_key, unnest(_rel.also_viewed), 'also_viewed'
  FROM pc{sfx} WHERE reject_reason IS NULL AND _cats IS NOT NULL),
s1_related_product{sfx} AS (SELECT * FROM s1_rel_all{sfx}
  WHERE length(rl_related_product_source_key) <= 10 AND length(rl_relation) <= 20),
s2_product_k{sfx} AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY p_product_source_key ORDER BY {nulls_first(PRODUCT_PAYLOAD)}) AS _rn
    FROM s1_product{sfx}) WHERE _rn = 1),
"""


def query(final: str, late_products: bool = False) -> str:
    return "WITH " + chain(late_products) + final
