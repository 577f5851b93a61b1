"""The persisted pipeline: batches over CSVs derived from sf0.001, aborts, failures and damaged state."""

import itertools
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from starloom.operators import audit as A
from starloom.plans import pipeline as P
from starloom.plans import standin as S
from starloom.plans import star
from starloom.sources import sinks as Sk
from starloom.sources.csv import csv_scan, write_csv

from conftest import SF001


def one_fact_per_grain(w):
    """No review stands twice, whatever versions its product has had."""
    keys = w["product"].select("product_key", "product_source_key")
    grain = ["date_reviewed_key", "reviewer_key", "product_source_key", "review_descriptors_key"]
    return w["review_fact"].join(keys, "product_key").groupBy(*grain).count().filter("count > 1").isEmpty()


def test_pipeline_batches(spark):
    work = tempfile.mkdtemp(prefix="starloom-test-pipeline-")
    rcsv, pcsv, p2csv = f"{work}/reviews", f"{work}/products", f"{work}/products2"
    write_csv(S.raw_reviews(spark, SF001), rcsv)
    write_csv(S.raw_products(spark, SF001), pcsv)
    write_csv(S.raw_products(spark, SF001, late=True), p2csv)
    write_csv(S.raw_products(spark, SF001, repriced=True), f"{work}/products3")
    root = f"{work}/wh"
    cfg = dict(root=root, date_start="1990-01-01", date_years=40)
    b1 = P.run_pipeline(spark, rcsv, pcsv, P.RunConfig(as_of="2024-01-01 00:00:00", **cfg))
    w = P.warehouse_tables(spark, root)
    n1 = w["review_fact"].count()
    assert n1 > 0
    assert w["product"].filter("is_current").groupBy("product_source_key").count().filter("count > 1").count() == 0
    q2 = star.rating_per_brand_per_month(w["review_fact"], w["product"], w["date"])
    assert q2.count() > 0
    # Same files again: no new dimension members, no new facts.
    b2 = P.run_pipeline(spark, rcsv, pcsv, P.RunConfig(as_of="2024-01-15 00:00:00", **cfg))
    w = P.warehouse_tables(spark, root)
    assert w["review_fact"].count() == n1
    # Complete product file: late products get real versions; history stays.
    b3 = P.run_pipeline(spark, rcsv, p2csv, P.RunConfig(as_of="2024-02-01 00:00:00", **cfg))
    w = P.warehouse_tables(spark, root)
    assert w["product"].filter(~F.col("is_current")).count() > 0
    assert one_fact_per_grain(w)
    assert w["review_fact"].count() == n1, "a new version of its product does not make a review another fact"
    # The partial file again: known products stay, and none becomes a placeholder.
    real = {r[0] for r in w["product"].filter("is_current and product_title <> '*Unknown title'").select("product_source_key").collect()}
    b4 = P.run_pipeline(spark, rcsv, f"{work}/products3", P.RunConfig(as_of="2024-03-01 00:00:00", **cfg))
    w = P.warehouse_tables(spark, root)
    still = {r[0] for r in w["product"].filter("is_current and product_title <> '*Unknown title'").select("product_source_key").collect()}
    assert real <= still and one_fact_per_grain(w) and w["review_fact"].count() == n1
    log = spark.read.parquet(f"{root}/audit/events")
    batches = {r.ib_id: r.ib_status for r in A.import_batch(log).collect()}
    assert batches == {b1: "Completed", b2: "Completed", b3: "Completed", b4: "Completed"}
    stats = A.import_statistics(log)
    assert {r.ib_id for r in stats.collect()} == {b4}
    t = A.import_batch_process_task(log).filter(F.col("ib_description") == "s1_reviews").first()
    assert t.ibpt_records_in == t.ibpt_records_failed + t.ibpt_records_out
    fact = A.import_batch_process_task(log).filter(F.col("ib_description") == "review_fact").orderBy("ibpt_id").first()
    assert fact.ibpt_records_in == fact.ibpt_records_failed + fact.ibpt_records_out
    names = {r[0] for r in A.import_batch_process_task(log).select("ib_description").distinct().collect()}
    assert {"category", "review_descriptors", "product_category_bridge", "related_product"} <= names


@pytest.fixture
def inputs(spark, tmp_path):
    write_csv(S.raw_reviews(spark, SF001).limit(200), f"{tmp_path}/reviews")
    write_csv(S.raw_products(spark, SF001).limit(50), f"{tmp_path}/products")
    return f"{tmp_path}/reviews", f"{tmp_path}/products", f"{tmp_path}/wh"


def states(spark, root):
    log = spark.read.parquet(f"{root}/audit/events")
    return {(r.level, r.status) for r in A.latest_state(log).collect()}, log


@pytest.mark.parametrize("error,status", [(KeyboardInterrupt, "Aborted"), (ValueError, "Failed")])
def test_abort_and_failure_are_recorded(spark, inputs, monkeypatch, error, status):
    reviews, products, root = inputs
    ticks = itertools.count()
    clock = lambda: f"2024-01-01 00:00:{next(ticks):02d}"

    def stop(*a, **k):
        raise error("stopped here")
    monkeypatch.setattr(P.St, "dedup_stage", stop)
    with pytest.raises(KeyboardInterrupt if error is KeyboardInterrupt else RuntimeError):
        P.run_pipeline(spark, reviews, products, P.RunConfig(root=root, as_of="2024-01-01 00:00:00", clock=clock))
    found, log = states(spark, root)
    assert ("batch", status) in found and ("process", status) in found and not any(s == "Running" for _, s in found)
    assert A.latest_running_batch(log).isEmpty()
    batch = A.latest_state(log).filter("level = 'batch'").first()
    assert batch.end_ts > batch.start_ts
    if status == "Failed":
        assert "stopped here" in batch.message


def test_unreadable_audit_log_changes_nothing(spark, inputs):
    """A log that cannot be read is an error, not an empty log."""
    reviews, products, root = inputs
    os.makedirs(f"{root}/audit/events")
    with open(f"{root}/audit/events/part-0.parquet", "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        P.run_pipeline(spark, reviews, products, P.RunConfig(root=root, as_of="2024-01-01 00:00:00"))
    assert os.listdir(root) == ["audit"]


def test_reviews_without_a_reviewer_get_the_unknown_member(spark, inputs):
    """Blank reviewer ids load as key -1 in each batch; its name stays, other keys start at 1."""
    reviews, products, root = inputs
    rows = csv_scan(spark, reviews).drop("_corrupt_record")
    blank = F.col("reviewerID").endswith("1")
    write_csv(rows.withColumn("reviewerID", F.when(~blank, F.col("reviewerID"))), f"{reviews}-blank")
    for as_of in ("2024-01-01 00:00:00", "2024-02-01 00:00:00"):
        P.run_pipeline(spark, f"{reviews}-blank", products, P.RunConfig(root=root, as_of=as_of, date_start="1990-01-01", date_years=40))
    w = P.warehouse_tables(spark, root)
    names = {r.reviewer_key: (r.reviewer_source_key, r.reviewer_name) for r in w["reviewer"].collect()}
    assert names[-1] == ("*Unknown", "*Unknown username") and min(k for k in names if k != -1) == 1
    assert [n for n, _ in names.values()].count("*Unknown") == 1
    assert not w["review_fact"].filter("reviewer_key = -1").isEmpty()
    assert w["date"].filter("date_key = 19000101").select("date_description").first()[0] == "*Unknown Date"


def test_half_written_version_is_not_current(spark, tmp_path):
    root = f"{tmp_path}/dim"
    Sk.write_version(spark.range(3), root, 1)
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/v=2")
    df, v = Sk.read_version(spark, root)
    assert v == 1 and df.count() == 3
    Sk.write_version(spark.range(5), root, v + 1)
    assert Sk.read_version(spark, root)[0].count() == 5
    assert Sk.read_version(spark, f"{tmp_path}/none") == (None, 0)


def put(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}.csv", "w", newline="") as f:
            f.write(text)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    """Files of one folder with other column orders, unnamed, missing, further and repeated columns."""
    put(tmp_path, a=",x,y\n0,1,2\n", b=",y,x\n5,4,3\n", c="y,x,\r\n8,7,6\r\n", d='"x"\n9\n', e='x,"more, ""1""\nline",x\nlost,m,10\n', f="",
        g="x,y\n11,12,13\n")
    got = csv_scan(spark, str(tmp_path))
    assert got.columns == ["_c0", "x", "y", 'more, "1"\nline', "_corrupt_record"]
    rows = sorted((tuple(r)[:4] for r in got.collect() if r["_corrupt_record"] is None), key=lambda r: int(r[1]))
    assert rows == [("0", "1", "2", None), ("5", "3", "4", None), ("6", "7", "8", None), (None, "9", None, None), (None, "10", None, "m")]
    assert [r["_corrupt_record"] for r in got.collect() if r["_corrupt_record"]] == ["11,12,13"]  # wider than its own header
    picked = csv_scan(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"], columns=["y", "x"])
    assert sorted(tuple(r) for r in picked.collect()) == [("2", "1", None), ("4", "3", None)]
    with pytest.raises(ValueError, match="column named z"):
        csv_scan(spark, str(tmp_path), columns=["x", "z"])
    assert csv_scan(spark, f"{tmp_path}/f.csv").count() == 0


def test_csv_headers_of_any_length_and_compressed(spark, tmp_path):
    import gzip
    names = [f"column_{i}" for i in range(5000)]  # a header line longer than one read
    put(tmp_path, long=",".join(names) + "\n" + ",".join(map(str, range(5000))) + "\n")
    assert csv_scan(spark, f"{tmp_path}/long.csv").select("column_0", "column_4999").first() == ("0", "4999")
    with gzip.open(f"{tmp_path}/z.csv.gz", "wt") as f:
        f.write("b,a\n1,2\n")
    assert csv_scan(spark, f"{tmp_path}/z.csv.gz").select("a", "b").first() == ("2", "1")
    put(f"{tmp_path}/odd [1]{{x}}", **{"n*": "b,a\n1,2\n"})
    assert csv_scan(spark, f"{tmp_path}/odd*").select("a", "b").first() == ("2", "1")


def test_uncommitted_batches_are_not_read(spark, tmp_path):
    root = f"{tmp_path}/t"
    assert Sk.read_table(spark, root) is None
    spark.range(7).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/batch=1")
    assert Sk.read_table(spark, root) is None
    Sk.write_batch_part(spark.range(3), root, 2)
    got = Sk.read_table(spark, root)
    assert got.count() == 3 and {r.batch for r in got.collect()} == {2}


def test_bucket_table_rewrites_what_changes(spark, tmp_path):
    """A commit touches its buckets' files only; one that stops half-way leaves no trace."""
    from starloom.operators import dims as Dm
    from starloom.sources.buckets import BucketTable
    t = BucketTable(spark, f"{tmp_path}/p", "k", "sk long, k string, a string, effective_date timestamp_ntz, "
                    "expiration_date timestamp_ntz, is_current boolean", buckets=8)
    snap = spark.range(200).selectExpr("cast(id as string) as k", "'x' as a")
    assert Dm.scd2_apply(t, snap, ["a"], "2024-01-01 00:00:00", 1, sk="sk") == {"records_in": 200, "type_2": 0, "dim_new": 200, "unchanged": 0}
    files = sorted(t.rows().inputFiles())
    assert Dm.scd2_apply(t, snap, ["a"], "2024-02-01 00:00:00", 2, sk="sk")["unchanged"] == 200
    assert sorted(t.rows().inputFiles()) == files and t.state().version == 1
    one = snap.filter("k = '17'").withColumn("a", F.lit("y"))
    assert Dm.scd2_apply(t, one, ["a"], "2024-03-01 00:00:00", 3, sk="sk")["type_2"] == 1
    assert len(set(t.rows().inputFiles()) & set(files)) == len(files) - 1
    dim = t.rows().unionByName(t.log())
    want, _ = Dm.scd2_merge(Dm.scd2_merge(None, snap, "k", ["a"], "2024-01-01 00:00:00", sk="sk")[0], one, "k", ["a"], "2024-03-01 00:00:00", sk="sk")
    assert sorted(map(str, dim.collect())) == sorted(map(str, want.select(*dim.columns).collect()))
    # a commit that wrote rows and log but no state
    t.rows().withColumn("bucket", t.bucket()).write.partitionBy("bucket").parquet(f"{t.root}/part/batch=9")
    t.rows().write.parquet(f"{t.root}/log/batch=9")
    assert t.rows().count() == 200 and t.log().count() == 1
    again = BucketTable(spark, f"{tmp_path}/p", "k", "sk long, k string", buckets=3)
    assert again.buckets == 8  # the number of buckets is the table's


def test_csv_to_json_files(spark, tmp_path):
    """A CSV path in, JSON lines out: keyed (the last row of a key wins) and typed."""
    import json
    with open(f"{tmp_path}/in.csv", "w") as f:
        f.write('k,v\na,1\nb,2.5\na,"x, ""y"""\nc,\n')
    Sk.csv_to_json(spark, f"{tmp_path}/in.csv", f"{tmp_path}/keyed", key="k")
    got = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/keyed").collect()]
    assert sorted(got, key=str) == [{"k": "a", "v": 'x, "y"'}, {"k": "b", "v": "2.5"}, {"k": "c", "v": ""}]
    Sk.csv_to_json(spark, f"{tmp_path}/in.csv", f"{tmp_path}/typed")
    got = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/typed").collect()]
    assert {"k": "a", "v": 1} in got and {"k": "b", "v": 2.5} in got and {"k": "c", "v": ""} in got and len(got) == 4


def test_last_row_of_several_csv_files_wins(spark, tmp_path):
    """Files in order of their names, whatever their sizes and column orders; rows of a file in order."""
    import json
    put(f"{tmp_path}/in", a="k,v\n" + "".join(f"k{i % 5},a{i}\n" for i in range(500)), b="v,k\nb1,k1\nb2,k1\n", c="k,v\nk2,c1\n")
    for _ in range(2):
        Sk.csv_to_json(spark, f"{tmp_path}/in", f"{tmp_path}/out", key="k")
        got = {r["k"]: r["v"] for r in (json.loads(x.value) for x in spark.read.text(f"{tmp_path}/out").collect())}
        assert got == {"k0": "a495", "k1": "b2", "k2": "c1", "k3": "a498", "k4": "a499"}
