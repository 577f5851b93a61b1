"""Physical-plan properties the scale design relies on."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators import dims as Dm
from starloom.operators import fact as Fa
from starloom.operators import joins as J
from starloom.operators import stage as St
from starloom.plans import star


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark):
    date = Dm.build_date_dim(spark, "2020-01-01", 1)
    fact = spark.createDataFrame([(20200501, 1, 1, 1, None, 4.0)],
                                 "date_reviewed_key int, reviewer_key long, product_key long, "
                                 "review_descriptors_key long, helpfulness_rating double, review_rating double")
    prods = spark.createDataFrame([(1, "P1", True, "X")], "product_key long, product_source_key string, "
                                                          "is_current boolean, brand string")
    return date, fact, prods


def test_star_query_aggregates_before_product_join(spark):
    date, fact, prods = _tables(spark)
    p = plan(star.rating_per_brand_per_month(fact, prods, date))
    assert "BroadcastHashJoin" in p                     # date dimension, bounded
    assert "partial_sum(review_rating" in p            # map-side combine of the fact rows
    # the fact's partial aggregate sits below (is printed after) the product join
    assert p.index("partial_sum(review_rating") > p.index("SortMergeJoin [product_key")


def test_fact_resolution_shuffles_no_text(spark):
    date, _, prods = _tables(spark)
    reviewers = spark.createDataFrame([(1, "R1", "n")], "reviewer_key long, reviewer_source_key string, "
                                                        "reviewer_name string")
    reviews = spark.createDataFrame([("R1", "P1", "n", 0.5, "long text " * 50, 5.0, "t", dt.datetime(2020, 5, 1))],
                                    "r_reviewer_source_key string, r_product_key string, r_reviewer_name string, "
                                    "r_helpfulness_rating double, r_review_text string, r_review_score double, "
                                    "r_review_title string, r_review_datetime timestamp_ntz")
    junk, _ = Dm.load_junk_dim(None, reviews.select(F.col("r_review_text").alias("review_text"),
                                                    F.col("r_review_title").alias("review_title")))
    resolved = Fa.resolve_fact_keys(St.review_view(reviews), reviewers, prods, junk, date)
    p = plan(resolved)
    for line in p.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "_text" not in line and "review_text" not in line, line


def test_restrict_to_keys_is_a_plain_semi_join(spark):
    big = spark.range(0, 1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    keys = spark.createDataFrame([("1",), ("2",), ("2",)], "k string")
    out = J.restrict_to_keys(big, "k", keys, "k")
    assert "LeftSemi" in plan(out) and out.count() == 2
