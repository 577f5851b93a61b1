"""Stand-in inputs built from the driver's test tables.

The source CSVs of the review warehouse are not part of the test data, so
rows *in the source schema* (every cell a string, Python-literal text for
dicts and lists) are derived from the TPC-H-like tables.  These builders
only shape rows; all cleaning, validation, keys and loading happen in the
library code that consumes them.  The same SQL text (with two small
dialect helpers) feeds Spark and the DuckDB oracle.

Roles:

* review  ← lineitem ⋈ orders ⋈ customer, text from ``documents`` where an
  order id matches a document id (else the cell is empty); some cells are
  malformed by data-derived conditions (a market segment and priority give
  an over-long reviewer id, one tax rate and return flag an over-long product key, line
  7 a one-element helpful list, pending orders an unparsable review time,
  zero discount an unparsable score) so every review rule is exercised;
* product ← part; a product's ``related`` lists the neighbouring part ids;
  ``p_size > 45`` parts arrive late (only in the second snapshot), so
  reviews and relations referencing them exercise late-arriving members;
  some sizes give a cell that one product rule rejects (price, metadata id,
  key, rank category, image URL, brand, categories that are no list), and
  the second snapshot has a new price for every seventh part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


class Dialect:
    def __init__(self, name: str):
        self.name = name

    def epoch_days(self, x: str) -> str:
        if self.name == "spark":
            return f"datediff(CAST({x} AS DATE), DATE'1970-01-01')"
        return f"date_diff('day', DATE '1970-01-01', CAST({x} AS DATE))"

    @property
    def lines(self) -> str:
        """Line items with their order and customer.

        On Spark the orders meet their customers first: line items are then shuffled
        once, by order, and stay so for the join with the documents.
        """
        if self.name == "spark":
            return """FROM {lineitem} l
JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey) ON l.l_orderkey = o.o_orderkey"""
        return """FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey"""

    def s(self, x: str) -> str:
        return f"CAST({x} AS STRING)" if self.name == "spark" else f"CAST({x} AS VARCHAR)"


SPARK, DUCK = Dialect("spark"), Dialect("duckdb")


def raw_reviews_sql(d: Dialect) -> str:
    s = d.s
    return f"""
SELECT
  {s('l.l_orderkey * 10 + l.l_linenumber')} AS _c0,
  CASE WHEN c.c_mktsegment = 'AUTOMOBILE' AND o.o_orderpriority = '1-URGENT'
       THEN 'A' || {s('o.o_custkey')} || '-' || c.c_mktsegment || '-' || o.o_orderpriority
       ELSE 'A' || {s('o.o_custkey')} END AS reviewerID,
  CASE WHEN l.l_tax = 0.08 AND l.l_returnflag = 'N' THEN 'B0' || lpad({s('l.l_partkey')}, 9, '0')
       ELSE {s('l.l_partkey')} END AS asin,
  c.c_name AS reviewerName,
  CASE WHEN l.l_linenumber = 7 THEN '[' || {s('l.l_linenumber')} || ']'
       ELSE '[' || {s('l.l_linenumber - 1')} || ', ' || {s('CAST(ROUND(l.l_tax * 100) AS INT)')} || ']' END
    AS helpful,
  doc.text AS reviewText,
  CASE WHEN l.l_discount = 0 THEN 'n/a'
       ELSE {s('CAST(CEIL(l.l_quantity / 10) AS INT)')} || '.0' END AS overall,
  CASE WHEN l.l_linestatus = 'O' THEN '  ' || o.o_orderpriority || '  '
       ELSE o.o_orderpriority || ' ' || l.l_returnflag END AS summary,
  CASE WHEN o.o_orderstatus = 'P' AND l.l_returnflag = 'A' THEN 'pending'
       ELSE {s(d.epoch_days('o.o_orderdate') + ' * 86400')} END AS unixReviewTime
{d.lines}
LEFT JOIN {{documents}} doc ON doc.doc_id = l.l_orderkey
"""


def raw_products_sql(d: Dialect, late: bool = False, repriced: bool | None = None) -> str:
    """Products as the CSV holds them; ``late=False`` withholds the late-arriving parts.

    ``repriced`` (by default with the late parts) gives every seventh part its new price.
    """
    s = d.s
    where = "" if late else "WHERE p.p_size <= 45"
    q = "''"
    lb, rb = "{{", "}}"  # literal braces that survive the table-binding format step
    price = s('p.p_retailprice')
    if late if repriced is None else repriced:
        price = f"CASE WHEN p.p_partkey % 7 = 0 THEN {s('p.p_retailprice + 1')} ELSE {price} END"
    return f"""
SELECT
  CASE WHEN p.p_size = 9 THEN 'M' || lpad({s('p.p_partkey')}, 9, '0') ELSE {s('p.p_partkey')} END AS metadataid,
  CASE WHEN p.p_size = 11 THEN 'P' || lpad({s('p.p_partkey')}, 10, '0') ELSE {s('p.p_partkey')} END AS asin,
  '{lb}{q}' || CASE WHEN p.p_size = 13 THEN repeat(p.p_type || '-', 12) ELSE p.p_type END || '{q}: ' || {s('p.p_size')} || '{rb}' AS salesrank,
  'http://img.example/' || CASE WHEN p.p_size = 15 THEN repeat('x', 225) ELSE '' END || {s('p.p_partkey')} || '.jpg' AS imurl,
  CASE WHEN p.p_size = 19 THEN '{lb}{q}' || p.p_type || '{q}: 1{rb}' ELSE '[[{q}' || p.p_type || '{q}, {q}' || split_part(p.p_name, ' ', 1) || '{q}], [{q}' || p.p_name || '{q}]]'
    END AS categories,
  p.p_name AS title,
  p.p_name || '  by ' || p.p_brand AS description,
  CASE WHEN p.p_size = 7 THEN 'n/a' ELSE {price} END AS price,
  '{lb}{q}also_bought{q}: [{q}' || {s('p.p_partkey + 1')} || '{q}, {q}' || {s('p.p_partkey + 2')}
    || '{q}], {q}also_viewed{q}: [{q}' || {s('p.p_partkey - 1')} || '{q}]{rb}' AS related,
  CASE WHEN p.p_size = 17 THEN repeat(p.p_brand || ' ', 30) ELSE p.p_brand END AS brand
FROM {{part}} p
{where}
"""


def load_tables(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def spark_sql(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    """Run a stand-in template on Spark with the referenced tables bound as DataFrames."""
    needed = [t for t in TABLES if "{" + t + "}" in template]
    return spark.sql(template, **load_tables(spark, sf_dir, needed))


def duck_sql(template: str) -> str:
    """The same template for DuckDB, where the tables are registered views."""
    return template.format(**{t: t for t in TABLES})


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, raw_reviews_sql(SPARK))


def raw_products(spark: SparkSession, sf_dir: str, late: bool = False, repriced: bool | None = None) -> DataFrame:
    return spark_sql(spark, sf_dir, raw_products_sql(SPARK, late, repriced))
