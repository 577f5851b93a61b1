"""Benchmark: the full review-warehouse load and the star queries.

Steps timed (seconds):

* ``load_batch1``  — CSV scan → stage 1 → stage 2 → dimensions → fact (batch 1);
* ``q1_category_month``, ``q2_brand_month`` — star queries on the loaded schema;
* ``q3_import_statistics`` — audit query for the newest batch;
* ``load_batch2`` — second batch with the complete product file (SCD2
  versions, late-arriving members resolved, fact re-load adds nothing).

Input CSVs are derived once from ``$BENCH_SF_DIR`` (not timed).  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from starloom.operators import audit as A  # noqa: E402
from starloom.plans import pipeline as P  # noqa: E402
from starloom.plans import standin as S  # noqa: E402
from starloom.plans import star  # noqa: E402
from starloom.session import build_session, scratch_path  # noqa: E402
from starloom.sources.csv import write_csv  # noqa: E402


PARALLEL = os.environ.get("BENCH_PARALLEL_STEPS", "1") == "1"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="starloom-bench-")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, extra={
        "spark.driver.memory": "16g",
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
        "spark.checkpoint.dir": f"{work}/checkpoints",
    })
    spark.sparkContext.setCheckpointDir(f"{work}/checkpoints")

    reviews_csv = scratch_path(spark, "reviews_csv")
    products_csv = scratch_path(spark, "products_csv")
    products2_csv = scratch_path(spark, "products2_csv")
    write_csv(S.raw_reviews(spark, sf_dir).repartition(int(cpus)), reviews_csv)
    write_csv(S.raw_products(spark, sf_dir), products_csv)
    write_csv(S.raw_products(spark, sf_dir, late=True), products2_csv)

    root = f"{work}/warehouse"
    times: dict[str, float] = {}

    steps: dict[str, dict[str, float]] = {"batch1": {}, "batch2": {}}
    t = time.time()
    P.run_pipeline(spark, reviews_csv, products_csv, P.RunConfig(
        root=root, as_of="2024-01-01 00:00:00", date_start="1990-01-01", date_years=40,
        parallel_steps=PARALLEL), timings=steps["batch1"])
    times["load_batch1"] = time.time() - t

    w = P.warehouse_tables(spark, root)
    t = time.time()
    star.rating_per_category_per_month(w["review_fact"], w["product"], w["product_category_bridge"],
                                       w["category"], w["date"]).collect()
    times["q1_category_month"] = time.time() - t
    t = time.time()
    star.rating_per_brand_per_month(w["review_fact"], w["product"], w["date"]).collect()
    times["q2_brand_month"] = time.time() - t
    t = time.time()
    A.import_statistics(spark.read.parquet(f"{root}/audit/events")).collect()
    times["q3_import_statistics"] = time.time() - t

    t = time.time()
    P.run_pipeline(spark, reviews_csv, products2_csv, P.RunConfig(
        root=root, as_of="2024-02-01 00:00:00", date_start="1990-01-01", date_years=40,
        parallel_steps=PARALLEL), timings=steps["batch2"])
    times["load_batch2"] = time.time() - t

    fact_rows = P.warehouse_tables(spark, root)["review_fact"].agg(F.count(F.lit(1))).first()[0]
    total = sum(times.values())
    print(json.dumps({"metric": "warehouse_load_and_star_queries", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()},
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "fact_rows": int(fact_rows), "steps": steps}))
    spark.stop()


if __name__ == "__main__":
    main()
