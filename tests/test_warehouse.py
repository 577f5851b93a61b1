"""Warehouse loaders on the FIXTURES.md §4 cases, plus key and plan properties."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import audit as A
from starloom.operators import bridge as B
from starloom.operators import dims as Dm
from starloom.operators import fact as Fa
from starloom.operators import keys as K
from starloom.operators import stage as St
from starloom.plans import star

SNAPS = {
    "2024-01-01 00:00:00": [("1", "a", 1.0), ("2", "b", 2.0), ("3", "c", None)],
    "2024-02-01 00:00:00": [("1", "a", 1.0), ("2", "B", 2.0), ("3", "c", None), ("4", "d", 4.0)],
    "2024-03-01 00:00:00": [("1", "a", 9.0), ("4", "d", 4.0), ("5", "e", None), ("3", "c", 3.0)],
}
SCHEMA = "product_source_key string, name string, price double"


def fold(spark, change="diff", snaps=SNAPS):
    dim = None
    for as_of, rows in snaps.items():
        dim, _ = Dm.scd2_merge(dim, spark.createDataFrame(rows, SCHEMA), "product_source_key",
                               ["name", "price"], as_of, change=change)
        dim = dim.checkpoint()
    return dim


def test_scd2_diff_fold(spark):
    dim = fold(spark)
    assert dim.count() == 8
    cur = dim.filter("is_current").groupBy("product_source_key").count()
    assert cur.filter("count != 1").count() == 0 and cur.count() == 5
    assert dim.filter("product_source_key = '2' AND is_current").first().name == "B"
    keys = sorted(r.product_key for r in dim.collect())
    assert keys == list(range(1, 9))
    # re-loading the last snapshot adds nothing
    last = list(SNAPS)[-1]
    again, counts = Dm.scd2_merge(dim, spark.createDataFrame(SNAPS[last], SCHEMA), "product_source_key",
                                  ["name", "price"], "2024-04-01 00:00:00")
    assert again.count() == 8 and counts.first().type_2 == 0


def test_scd2_always_adds_a_version_per_matched_key(spark):
    dim = fold(spark)
    last = list(SNAPS)[-1]
    again, _ = Dm.scd2_merge(dim, spark.createDataFrame(SNAPS[last], SCHEMA), "product_source_key",
                             ["name", "price"], "2024-04-01 00:00:00", change="always")
    assert again.count() == 12


def test_scd2_history_equals_fold(spark):
    log = None
    for as_of, rows in SNAPS.items():
        part = spark.createDataFrame(rows, SCHEMA).withColumn("as_of", F.lit(as_of).cast("timestamp_ntz"))
        log = part if log is None else log.unionByName(part)
    hist = Dm.scd2_history(log, "product_source_key", ["name", "price"])
    cols = ["product_key", "product_source_key", "name", "price", "effective_date", "expiration_date", "is_current"]
    assert sorted(map(tuple, hist.select(*cols).collect()), key=str) == \
        sorted(map(tuple, fold(spark).select(*cols).collect()), key=str)


def test_scd1_fixture(spark):
    existing = spark.createDataFrame([(1, "r1", "old")], "reviewer_key long, reviewer_source_key string, "
                                                          "reviewer_name string")
    inc = spark.createDataFrame([("r1", "new", dt.datetime(2024, 1, 2)), ("r1", "mid", dt.datetime(2024, 1, 1)),
                                 ("r2", "x", dt.datetime(2024, 1, 1))],
                                "reviewer_source_key string, reviewer_name string, review_datetime timestamp")
    dim, counts = Dm.scd1_upsert(existing, inc)
    got = {r.reviewer_source_key: (r.reviewer_key, r.reviewer_name) for r in dim.collect()}
    assert got == {"r1": (1, "new"), "r2": (2, "x")}
    c = counts.first()
    assert (c.type_1, c.dim_new) == (1, 1)


def product_dim(spark, keys):
    return spark.createDataFrame([(i + 1, k, True) for i, k in enumerate(keys)],
                                 "product_key long, product_source_key string, is_current boolean")


def test_bridge_fixture(spark):
    prods = product_dim(spark, ["p1", "p2"])
    cats = spark.createDataFrame([(1, "c1"), (2, "c2")], "category_key long, product_category string")
    existing = spark.createDataFrame([(1, 1)], "product_key long, category_key long")
    pairs = spark.createDataFrame([("p1", "c1"), ("p1", "c2"), ("p2", "c1"), ("p2", "c2"), ("p2", "zz")],
                                  "pc_product_source_key string, pc_category string")
    bridge, added, bad = B.load_bridge(pairs, prods, cats, existing)
    assert added.count() == 3 and bridge.count() == 4
    assert [r.reject_reason for r in bad.collect()] == ["unknown category"]
    _, again, _ = B.load_bridge(pairs, prods, cats, bridge)
    assert again.count() == 0


def test_related_fixture(spark):
    prods = product_dim(spark, ["p1", "p2"])
    edges = spark.createDataFrame([("p1", "p2", "also_viewed"), ("p1", "p2", "also_bought")],
                                  "rl_product_source_key string, rl_related_product_source_key string, "
                                  "rl_relation string")
    table, added, _ = B.load_related(edges, prods)
    assert [tuple(r) for r in table.collect()] == [(1, 2, "also_bought")]


def test_junk_fixture_and_collision_lookup(spark):
    rev = spark.createDataFrame([("t", "a"), ("t", "a"), ("t", "b")], "review_text string, review_title string")
    dim, added = Dm.load_junk_dim(None, rev)
    assert dim.count() == 2
    _, again = Dm.load_junk_dim(dim, rev)
    assert again.count() == 0
    # Two different pairs forced onto one hash: the lookup must fall back to the texts.
    forged = spark.createDataFrame([(1, "x", "y", "h"), (2, "x", "z", "h"), (3, "q", "r", "g")],
                                   "review_descriptors_key long, review_text string, review_title string, "
                                   "descriptor_hash string")
    unique, collided = Fa.descriptor_lookup(forged)
    assert [tuple(r) for r in unique.collect()] == [("g", 3)]
    assert collided.count() == 2


def test_fact_fixture(spark):
    date = Dm.build_date_dim(spark, "2020-01-01", 1)
    reviewers = spark.createDataFrame([(1, "R1", "n")], "reviewer_key long, reviewer_source_key string, "
                                                        "reviewer_name string")
    prods = product_dim(spark, ["P1"])
    rv_cols = ("r_reviewer_source_key string, r_product_key string, r_reviewer_name string, "
               "r_helpfulness_rating double, r_review_text string, r_review_score double, r_review_title string, "
               "r_review_datetime timestamp_ntz")
    reviews = spark.createDataFrame([
        ("R1", "P1", "n", 0.5, "good", 5.0, "t", dt.datetime(2020, 5, 1)),      # resolves
        ("R1", "PX", "n", 0.5, "good", 5.0, "t", dt.datetime(2020, 5, 1)),      # unknown product
        ("R1", "P1", "n", 0.5, "old", 4.0, "t", dt.datetime(1999, 5, 1)),       # before the date dimension
        ("R1", "P1", "n", 0.1, "good", 3.0, "t", dt.datetime(2020, 5, 1)),      # duplicate key
    ], rv_cols)
    junk, _ = Dm.load_junk_dim(None, reviews.select(F.col("r_review_text").alias("review_text"),
                                                    F.col("r_review_title").alias("review_title")))
    rows, bad, _ = Fa.load_fact(St.review_view(reviews), reviewers, prods, junk, date)
    assert rows.count() == 1 and rows.first().review_rating == 5.0
    assert sorted(r.reject_reason for r in bad.collect()) == ["date outside date dimension", "duplicate key",
                                                               "unknown product"]
    again, _, _ = Fa.load_fact(St.review_view(reviews), reviewers, prods, junk, date, existing=rows)
    assert again.count() == 0


def test_date_dimension(spark):
    d = Dm.build_date_dim(spark)
    assert d.count() == 10959
    r = d.filter("date_key = 20180323").first()
    assert (r.day_of_week, r.month_of_year, r.quarter, r.date_description) == \
        ("Friday", "March", 1, "Friday, 23 March 2018")


def test_surrogate_keys_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).cast("string").alias("k"))
    keyed = K.assign_surrogate_keys(df, ["k"], "sk", start_after=10)
    want = df.withColumn("sk", F.row_number().over(Window.orderBy("k")) + 10)
    assert sorted(map(tuple, keyed.collect())) == sorted(map(tuple, want.collect()))


def test_dedupe_plan_has_no_unpartitioned_window(spark):
    df = spark.range(0, 100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    kept, dropped = K.dedupe_on_key(df, ["k"])
    plan = kept._jdf.queryExecution().executedPlan().toString() + dropped._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert kept.count() == 7 and dropped.count() == 93


def test_reciprocal_anti_is_one_shuffle(spark):
    """One aggregation on the unordered pair; same rows as the rule read literally, nulls and self-loops included."""
    from starloom.operators.joins import met_pairs, reciprocal_anti
    rows = [("a", "b", "r"), ("b", "a", "q"), ("a", "c", "r"), ("a", "c", "q"), ("a", "c", "r"), ("d", "d", "r"), (None, "a", "r"),
            ("a", None, "r"), ("c", "e", "r"), (None, None, "r")]
    e = spark.createDataFrame(rows, "s string, d string, r string").repartition(3)
    plan = reciprocal_anti(e, "s", "d")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    pairs = {(s, d) for s, d, _ in rows}
    want = {t for t in rows if None in t[:2] or (t[1], t[0]) not in pairs}
    assert sorted(map(tuple, reciprocal_anti(e, "s", "d").collect()), key=str) == sorted(want, key=str)
    met = met_pairs(spark.createDataFrame([("e", "c", "x"), ("a", "c", "x")], "s string, d string, r string"), "s", "d")
    got = {tuple(r) for r in reciprocal_anti(e, "s", "d", met).collect()}
    assert got == want - {("c", "e", "r")}  # the reverse came before; the same direction again does not count


def test_hot_key_spreads_in_both_outputs(spark):
    """A third of the rows on one key: its rejects are dealt over the tasks, the kept rows are right."""
    n = 3000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                               F.col("id").alias("v"), F.lit("x" * 50).alias("t"))
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept, dropped = K.dedupe_on_key(df, ["k"])
        tasks = dropped.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        assert sum(r["count"] for r in tasks) == 999 and len(tasks) == 8 and max(r["count"] for r in tasks) < 250
        assert kept.count() == n - 999 and kept.filter("k = 'hot'").first().v == 0
        assert "Join" not in dropped._jdf.queryExecution().optimizedPlan().toString().split("Union")[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)


def test_keys_hold_over_batches(spark):
    from starloom.operators import key_index as Ki
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None), ("c", 1, "n"), ("c", 2, "o"), ("c", 2, "o")], "k string, v int, t string")
    seen = spark.createDataFrame([("a", 2, "y"), ("b", 1, ""), ("z", 1, "q")], "k string, v int, t string") \
        .select("k", Ki.row_digest(["k", "v", "t"]).alias(Ki.DIGEST))
    kept, rejects = Ki.dedupe_across(rows, ["k"], seen)
    assert [tuple(r) for r in kept.collect()] == [("c", 1, "n")]
    assert sorted(tuple(r)[:2] for r in rejects.collect()) == [("a", 1), ("b", 1), ("c", 2)]  # a null is not the empty text


def test_event_time_versions_as_an_as_of_merge(spark, monkeypatch):
    """A product with a thousand versions and a third of the reviews, against the interval test; hot months are dealt."""
    import datetime as dt
    import random
    from starloom.operators import fact as Fa
    rnd, day = random.Random(3), dt.datetime(2020, 1, 1)
    versions, reviews, key = [], [], 0
    for psk, n in [("hot", 1000), ("one", 1), ("gap", 3)] + [(f"p{i}", rnd.choice([1, 2, 5])) for i in range(20)]:
        starts = sorted(rnd.sample(range(1200), n))
        for i, s in enumerate(starts):
            key += 1
            end = starts[i + 1] if i + 1 < n else (s + 1 if psk == "gap" else None)
            versions.append((psk, key, None if i == 0 else day + dt.timedelta(days=s), None if end is None else day + dt.timedelta(days=end)))
    for i in range(3000):
        psk = "hot" if i % 3 == 0 else rnd.choice(["one", "gap", "none"] + [f"p{j}" for j in range(20)])
        at = day + dt.timedelta(days=rnd.randrange(-100, 1400) if i % 6 else 40, seconds=rnd.choice([0, 0, 5]))
        reviews.append((f"r{i}", psk, f"h{i % 7}", None if i % 50 == 1 else at, i))
    v = spark.createDataFrame(versions, "product_source_key string, product_key long, _valid_from timestamp_ntz, _valid_to timestamp_ntz")
    r = spark.createDataFrame(reviews, "_rsk string, _psk string, _h string, _ts timestamp_ntz, n int")
    want = r.join(v, (F.col("_psk") == F.col("product_source_key")) & (F.col("_valid_from").isNull() | (F.col("_ts") >= F.col("_valid_from")))
                  & (F.col("_valid_to").isNull() | (F.col("_ts") < F.col("_valid_to"))), "left").select("n", "product_key")
    want = sorted(map(tuple, want.collect()))
    for share in (1000, 2):
        monkeypatch.setattr(Fa, "HOT_SHARE", share)
        bound = Fa.bind_versions(r, v)
        assert sorted(map(tuple, bound.select("n", "product_key").collect())) == want
        assert bound.columns == [*r.columns, "product_key"]


def test_event_time_months_are_counted_before_the_joins(spark, monkeypatch):
    """The count of a key's months reads no dimension, so the joins with descriptors and reviewers run once."""
    plans, real = [], Fa.materialize
    def kept(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df)
    monkeypatch.setattr(Fa, "materialize", kept)
    reviews = spark.createDataFrame([("R1", "P1", "n", None, "t", 4.0, "u", dt.datetime(2024, 1, 5)), ("R2", "P1", "n", None, "t", 3.0, "u", dt.datetime(2024, 2, 5)),
                                     ("R2", "P9", "n", None, "x", 3.0, "u", None)],
                                    "r_reviewer_source_key string, r_product_key string, r_reviewer_name string, r_helpfulness_rating double, "
                                    "r_review_text string, r_review_score double, r_review_title string, r_review_datetime timestamp_ntz")
    reviewers = spark.createDataFrame([(1, "R1"), (2, "R2")], "reviewer_key long, reviewer_source_key string")
    first, second = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    products = spark.createDataFrame([(1, "P1", first, second, False), (2, "P1", second, None, True)],
                                     "product_key long, product_source_key string, effective_date timestamp_ntz, expiration_date timestamp_ntz, is_current boolean")
    keys, _ = Dm.new_descriptors(reviews.select(F.col("r_review_text").alias("review_text"), F.col("r_review_title").alias("review_title")), None, 0)
    j = Fa.resolve_fact_keys(St.review_view(reviews), reviewers, products, keys, Dm.build_date_dim(spark, "2024-01-01", 1), "event")
    assert len(plans) == 1 and "Join" not in plans[0]
    assert sorted((r._rsk, r._psk, r.product_key, r.reject_reason) for r in j.collect()) == [
        ("R1", "P1", 1, None), ("R2", "P1", 2, None), ("R2", "P9", None, Fa.MISSING_PRODUCT)]


def test_q1_counts_review_once_per_category(spark):
    date = Dm.build_date_dim(spark, "2020-01-01", 1)
    fact = spark.createDataFrame([(20200501, 1, 1, 1, None, 4.0)],
                                 "date_reviewed_key int, reviewer_key long, product_key long, "
                                 "review_descriptors_key long, helpfulness_rating double, review_rating double")
    prods = product_dim(spark, ["P1"]).withColumn("brand", F.lit("X"))
    bridge = spark.createDataFrame([(1, 1), (1, 2)], "product_key long, category_key long")
    cats = spark.createDataFrame([(1, "c1"), (2, "c2")], "category_key long, product_category string")
    q1 = star.rating_per_category_per_month(fact, prods, bridge, cats, date)
    assert sorted(r.product_category for r in q1.collect()) == ["c1", "c2"]
    q2 = star.rating_per_brand_per_month(fact, prods, date)
    assert [(r.brand, r.year, r.month_of_year, r.avg_review_rating) for r in q2.collect()] == [("X", 2020, "May", 4.0)]


def test_q3_newest_batch_only(spark):
    ev = [A.batch_event(spark, 1, "b", A.RUNNING, "2024-01-01 00:00:00", 1),
          A.process_event(spark, 11, 1, "p", A.RUNNING, "2024-01-01 00:00:00", 2),
          A.task_event(None, spark, 111, 11, "t", A.COMPLETED, "2024-01-01 00:01:00", 3),
          A.batch_event(spark, 2, "b", A.RUNNING, "2024-02-01 00:00:00", 1),
          A.process_event(spark, 21, 2, "p", A.RUNNING, "2024-02-01 00:00:00", 2),
          A.task_event(None, spark, 211, 21, "t", A.RUNNING, "2024-02-01 00:00:00", 3)]
    log = ev[0]
    for e in ev[1:]:
        log = log.unionByName(e)
    q3 = A.import_statistics(log)
    assert [(r.ib_id, r.ibpt_id) for r in q3.collect()] == [(2, 211)]
    assert [r.ib_id for r in A.latest_running_batch(log).collect()] == [2]
    failed = A.record_failure(log, "2024-02-01 00:05:00", 4, "boom")
    assert sorted((r.level, r.id) for r in failed.collect()) == [("batch", 2), ("process", 21), ("task", 211)]


def test_fact_lookup_through_hash_collision(spark):
    """Two dimension rows share one hash: the review is matched on its texts."""
    date = Dm.build_date_dim(spark, "2020-01-01", 1)
    reviewers = spark.createDataFrame([(1, "R1", "n")], "reviewer_key long, reviewer_source_key string, "
                                                        "reviewer_name string")
    prods = product_dim(spark, ["P1"])
    h = spark.range(1).select(Dm.descriptor_hash(F.lit("x"), F.lit("y")).alias("h")).first().h
    junk = spark.createDataFrame([(7, "p", "q", h), (8, "x", "y", h)],
                                 "review_descriptors_key long, review_text string, review_title string, "
                                 "descriptor_hash string")
    reviews = spark.createDataFrame([("R1", "P1", "n", 0.5, "x", 5.0, "y", dt.datetime(2020, 5, 1))],
                                    "r_reviewer_source_key string, r_product_key string, r_reviewer_name string, "
                                    "r_helpfulness_rating double, r_review_text string, r_review_score double, "
                                    "r_review_title string, r_review_datetime timestamp_ntz")
    rows, bad, _ = Fa.load_fact(St.review_view(reviews), reviewers, prods, junk, date)
    assert [r.review_descriptors_key for r in rows.collect()] == [8]
    assert bad.count() == 0


def test_fact_event_time_binding(spark):
    date = Dm.build_date_dim(spark, "1999-01-01", 26)
    reviewers = spark.createDataFrame([(1, "R1", "n")], "reviewer_key long, reviewer_source_key string, "
                                                        "reviewer_name string")
    prods = spark.createDataFrame([
        (1, "P1", dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), False),
        (2, "P1", dt.datetime(2024, 2, 1), None, True)],
        "product_key long, product_source_key string, effective_date timestamp_ntz, "
        "expiration_date timestamp_ntz, is_current boolean")
    rv_cols = ("r_reviewer_source_key string, r_product_key string, r_reviewer_name string, "
               "r_helpfulness_rating double, r_review_text string, r_review_score double, r_review_title string, "
               "r_review_datetime timestamp_ntz")
    reviews = spark.createDataFrame([
        ("R1", "P1", "n", 0.5, "a", 5.0, "t", dt.datetime(2024, 1, 15)),
        ("R1", "P1", "n", 0.5, "b", 5.0, "t", dt.datetime(2024, 3, 1)),
        ("R1", "P1", "n", 0.5, "c", 5.0, "t", dt.datetime(1999, 6, 1))], rv_cols)
    junk, _ = Dm.load_junk_dim(None, reviews.select(F.col("r_review_text").alias("review_text"),
                                                    F.col("r_review_title").alias("review_title")))
    ev, _, _ = Fa.load_fact(St.review_view(reviews), reviewers, prods, junk, date, product_version="event")
    got = sorted((r.date_reviewed_key, r.product_key) for r in ev.collect())
    assert got == [(19990601, 1), (20240115, 1), (20240301, 2)]
    ld, _, _ = Fa.load_fact(St.review_view(reviews), reviewers, prods, junk, date)
    assert {r.product_key for r in ld.collect()} == {2}


def test_warehouse_tables_are_computed_when_asked_for(spark):
    """Relations come from the products alone: reviews that cannot be read do not matter to them."""
    from starloom.plans import standin, warehouse
    broken = standin.raw_reviews(spark, "/root/testdata/sf0.001").withColumn("overall", F.raise_error(F.lit("reviews read")))
    wh = warehouse.build_warehouse(broken, standin.raw_products(spark, "/root/testdata/sf0.001"), "2024-01-01 00:00:00")
    assert wh.stage1.related.count() > 0 and wh.stage2.categories.count() > 0


def test_materialized_frames_are_compressed_columns(spark):
    from starloom.session import materialize
    df = materialize(spark.range(1000).select("id", F.repeat(F.lit("same text "), 100).alias("t")))
    files = df.inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert df.count() == 1000 and df.columns == ["id", "t"]


def test_rows_of_single_keys_pass_the_key_rule_without_a_shuffle(spark):
    from starloom.operators.keys import dedupe_on_key
    rows_ = spark.range(5000).select((F.col("id") % 4990).alias("k"), F.repeat(F.lit("x"), 500).alias("t"), "id")
    stored = rows_.localCheckpoint()
    kept, dropped = dedupe_on_key(stored, ["k"])
    assert kept.count() == 4990 and dropped.count() == 10
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [k" in plan and "count(1)" not in plan  # the count per key is done, its few keys are stored
    physical = kept._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical


def test_line_items_are_shuffled_once_for_the_raw_reviews(spark):
    from starloom.plans import standin
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = standin.raw_reviews(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 5  # orders, customers, their join, line items, documents


def test_quarantine_is_compressed(spark, tmp_path):
    from starloom.sources import sinks
    df = spark.createDataFrame([("a", "r", "{}"), ("b", "r", "{}")], "entity string, reason string, row string")
    sinks.write_quarantine(df, str(tmp_path / "q"))
    assert list((tmp_path / "q").rglob("*.json.gz")) and not list((tmp_path / "q").rglob("*.json"))
    assert spark.read.json(str(tmp_path / "q")).count() == 2


def test_first_loads_start_no_python_for_the_empty_dimension(spark):
    rows = spark.range(1, 4).select(F.concat(F.lit("r"), "id").alias("reviewer_source_key"), F.lit("n").alias("reviewer_name"),
                                    F.lit("2024-01-01").cast("timestamp_ntz").alias("review_datetime"))
    dim, counts = Dm.scd1_upsert(None, rows)
    assert [r.reviewer_key for r in dim.orderBy("reviewer_key").collect()] == [1, 2, 3] and counts.first().dim_new == 3
    assert "ExistingRDD" not in dim._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in counts._jdf.queryExecution().executedPlan().toString()


def test_classification_is_written_in_compiled_methods(spark, monkeypatch):
    from starloom.plans import warehouse as W
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)
    monkeypatch.setattr(W, "materialize", lambda df: seen.append(spark.conf.get(name)) or df)
    raw = spark.createDataFrame([("1", "A", "B", "n", "[1, 2]", "text", "5.0", "t", "86400")],
                                "_c0 string, reviewerID string, asin string, reviewerName string, helpful string, reviewText string, "
                                "overall string, summary string, unixReviewTime string")
    assert W.classified_reviews(raw).count() == 1
    assert seen[0] == "8000" and spark.conf.get(name) == before
