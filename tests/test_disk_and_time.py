"""What the jobs leave on disk, and how their costly steps are planned."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from starloom.operators import key_index as Ki
from starloom.operators import stage as St
from starloom.plans import catalog
from starloom.plans import pipeline as P
from starloom.plans import standin as S
from starloom.session import finished_shuffles_removed, settings
from starloom.sources.csv import write_csv

HUGE = "spark.sql.codegen.hugeMethodLimit"


@pytest.fixture
def tables(spark, tmp_path):
    """A folder of small source tables."""
    day = F.expr("timestamp_ntz'2001-03-04 00:00:00' + make_dt_interval(id % 900)")
    orders = spark.range(1, 121).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 30).alias("o_custkey"), F.expr("elt(id % 3 + 1, 'O', 'F', 'P')").alias("o_orderstatus"),
        day.alias("o_orderdate"), F.expr("elt(id % 2 + 1, '1-URGENT', '5-LOW')").alias("o_orderpriority"))
    customer = spark.range(30).select(F.col("id").alias("c_custkey"), F.concat(F.lit("Customer#"), "id").alias("c_name"),
                                      F.expr("elt(id % 2 + 1, 'AUTOMOBILE', 'MACHINERY')").alias("c_mktsegment"))
    lineitem = spark.range(600).select(
        (F.col("id") % 120 + 1).alias("l_orderkey"), (F.col("id") % 47).alias("l_partkey"), F.expr("CAST(id div 120 + 1 AS INT)").alias("l_linenumber"),
        (F.col("id") % 50).cast("double").alias("l_quantity"), F.expr("(id % 11) / 100.0D").alias("l_discount"), F.expr("(id % 9) / 100.0D").alias("l_tax"),
        F.expr("elt(id % 3 + 1, 'A', 'N', 'R')").alias("l_returnflag"), F.expr("elt(id % 2 + 1, 'O', 'F')").alias("l_linestatus"))
    documents = spark.range(1, 20).select(F.col("id").alias("doc_id"), F.concat(F.lit('a "text",\nnumber '), "id").alias("text"))
    part = spark.range(47).select(F.col("id").alias("p_partkey"), F.concat(F.lit("red part "), "id").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
                                  F.lit("TIN").alias("p_type"), (F.col("id") + 5).cast("int").alias("p_size"), F.lit(9.5).alias("p_retailprice"))
    for name, df in (("orders", orders), ("customer", customer), ("lineitem", lineitem), ("documents", documents), ("part", part)):
        df.write.parquet(f"{tmp_path}/sf/{name}.parquet")
    return f"{tmp_path}/sf"


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}


def left_over(spark, before):
    """New shuffle files; they are removed a moment after a job's end."""
    for _ in range(40):
        new = shuffle_files(spark) - before
        if not new:
            break
        time.sleep(0.5)
    return new


def names(folder):
    return [f for f in glob.glob(f"{folder}/**/part-*", recursive=True) if os.path.isfile(f)]


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    before = shuffle_files(spark)
    with finished_shuffles_removed(spark):
        rows = spark.range(1000).repartition(3, "id")
        rows.write.parquet(f"{tmp_path}/out")
        assert len(rows.collect()) == 1000
        assert not left_over(spark, before)
        assert len(rows.collect()) == 1000  # a frame can run again
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1000


def test_a_batch_leaves_no_shuffle_files_and_deals_its_products(spark, tables, tmp_path, monkeypatch):
    write_csv(S.raw_reviews(spark, tables), f"{tmp_path}/r")
    write_csv(S.raw_products(spark, tables).coalesce(1), f"{tmp_path}/p")
    limits, classify = [], St.classify_reviews
    monkeypatch.setattr(St, "classify_reviews", lambda d, *a, **k: limits.append(spark.conf.get(HUGE)) or classify(d, *a, **k))
    root, before, limit = f"{tmp_path}/wh", shuffle_files(spark), spark.conf.get(HUGE)
    for month in (1, 2):
        P.run_pipeline(spark, f"{tmp_path}/r", f"{tmp_path}/p", P.RunConfig(root=root, as_of=f"2024-0{month}-01 00:00:00"))
    assert len(left_over(spark, before)) == 0
    assert limits == ["8000", "8000"] and spark.conf.get(HUGE) == limit
    assert len(names(f"{root}/stage1/products/batch=1")) > 1
    assert Ki.DIGEST not in spark.read.parquet(f"{root}/stage2/review/batch=1").columns
    index = spark.read.parquet(P.review_keys(spark, root).root)
    facts = P.warehouse_tables(spark, root)["review_fact"]
    assert index.filter("batch = 1").count() > 0 and index.filter("batch = 2").count() == 0  # rows met again are known by their digest
    assert facts.count() > 0 and facts.filter("batch = 2").count() == 0


def test_index_digests_are_short_and_older_ones_still_match(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "k string, v int, t string")
    short = Ki.row_digest(rows.columns)
    assert {len(r[0]) for r in rows.select(short).collect()} == {Ki.DIGEST_BYTES}
    seen = rows.select("k", F.concat(short, F.lit(b"sixteen more of it")).alias(Ki.DIGEST))
    kept, rejects = Ki.dedupe_across(rows.union(spark.createDataFrame([("a", 2, "x"), ("c", 1, "y")], rows.schema)), ["k"], seen)
    assert [r.k for r in kept.collect()] == ["c"] and [(r.k, r.v) for r in rejects.collect()] == [("a", 2)]


def test_rows_meet_the_taken_keys_without_their_digest(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(Ki, "materialize", lambda df: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or df)
    rows = spark.range(50).selectExpr("cast(id as string) k", "id v")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        Ki.dedupe_across(rows, ["k"], rows.select("k", Ki.row_digest(rows.columns).alias(Ki.DIGEST)))
    above = plans[0].split("Join")[0]
    assert "sha2" in above  # taken after the join


def test_three_cumulative_batches_read_one_stored_copy(spark, tables, monkeypatch):
    before, made, copied = shuffle_files(spark), [], []
    raw, materialize = S.raw_reviews, catalog.materialize
    monkeypatch.setattr(S, "raw_reviews", lambda *a: made.append(raw(*a)) or made[-1])
    monkeypatch.setattr(catalog, "materialize", lambda df: copied.append(df) or materialize(df))
    reviews, rejects, edges = catalog.cumulative_stage2(spark, tables)
    assert any(df is made[-1] for df in copied)
    assert not left_over(spark, before)
    assert {r.batch for r in reviews.select("batch").distinct().collect()} == {1, 2} and rejects.count() > 0 and edges.count() > 0


@pytest.mark.parametrize("query, folders", [(catalog.stream_ingest, ["drop"]), (catalog.stream_by_name, ["drop2"]), (catalog.s11, ["s11_csv", "s11_json"])])
def test_texts_on_disk_are_compressed(spark, tables, tmp_path, monkeypatch, query, folders):
    monkeypatch.setattr(catalog, "_scratch", lambda spark, name: f"{tmp_path}/{name}")
    before = shuffle_files(spark)
    got = query(spark, tables)
    assert not left_over(spark, before)
    assert got.count() == 600
    for folder in folders:
        files = names(f"{tmp_path}/{folder}")
        assert files and all(f.endswith(".gz") for f in files)
