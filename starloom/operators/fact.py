"""Review fact load.

Each stage-2 review resolves four keys: reviewer (SCD1 dimension), product
(current SCD2 version at load time), review descriptors (junk dimension,
matched on hash + text + title), and the date key, which must exist in the
date dimension.  Rows with an unresolved key are quarantined with the
first missing key as reason (D15); duplicate primary keys keep one row
(K1); facts already loaded, under whatever version of their product, are
skipped, so a re-run adds nothing (D16).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import materialize
from .bridge import current_products
from .dims import UNKNOWN_DATE_KEY, descriptor_digest, descriptor_hash
from .keys import dedupe_on_key
from .validate import REASON

FACT_PK = ["date_reviewed_key", "reviewer_key", "product_key", "review_descriptors_key"]
FACT_COLUMNS = [*FACT_PK, "helpfulness_rating", "review_rating"]

# What a fact is about: a later version of the product does not make it another fact.
FACT_GRAIN = ["date_reviewed_key", "reviewer_key", "_psk", "review_descriptors_key"]

# Reasons for reviews whose keys do not resolve.
MISSING_REVIEWER = "unknown reviewer"
MISSING_PRODUCT = "unknown product"
MISSING_DESCRIPTORS = "unknown review descriptors"
MISSING_DATE = "date outside date dimension"


def descriptor_lookup(junk_dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the junk dimension by whether its hash identifies one row.

    Returns (hash → key for unique hashes, full rows of colliding hashes).
    The first side carries no text, so the fact resolution shuffles 32-byte
    hashes instead of review texts; the second is empty unless two
    different (text, title) pairs share an md5, and then those reviews are
    matched on the texts themselves, so the lookup stays exact.
    """
    per_hash = junk_dim.groupBy("descriptor_hash").agg(
        F.count(F.lit(1)).alias("_n"), F.min("review_descriptors_key").alias("review_descriptors_key"))
    unique = per_hash.filter(F.col("_n") == 1).select("descriptor_hash", "review_descriptors_key")
    collided = junk_dim.join(per_hash.filter(F.col("_n") > 1).select("descriptor_hash"), "descriptor_hash",
                             "left_semi")
    return unique, collided


def product_versions_at(product_dim: DataFrame) -> DataFrame:
    """Validity interval of every product version for event-time lookups (H7).

    A version is valid from its ``effective_date`` to its ``expiration_date``
    (open at the end for the current one); the first version of a key is
    also valid before it was loaded, so older reviews bind to it.  The first
    start per key is a per-key aggregate (a key has one row per version).
    """
    v = product_dim.select("product_source_key", "product_key", "effective_date", "expiration_date")
    first = v.groupBy("product_source_key").agg(F.min("effective_date").alias("_first"))
    return (v.join(first, "product_source_key")
            .select("product_source_key", "product_key",
                    F.when(F.col("effective_date") > F.col("_first"), F.col("effective_date")).alias("_valid_from"),
                    F.col("expiration_date").alias("_valid_to")))


def resolve_fact_keys(reviews: DataFrame, reviewer_dim: DataFrame, product_dim: DataFrame,
                      junk_dim: DataFrame, date_dim: DataFrame, product_version: str = "load") -> DataFrame:
    """Join the four lookups; adds the surrogate keys and a ``reject_reason``.

    The date dimension is bounded (one row per calendar day) and is
    broadcast; the other dimensions grow with the data and are left to AQE
    (broadcast when measured small, else sort-merge with skew splitting).
    Review texts are reduced to their hash before any shuffle; see
    :func:`descriptor_lookup` for the exact handling of hash collisions.

    ``junk_dim`` is the dimension with its texts, or the narrow key table of
    :func:`~starloom.operators.dims.new_descriptors` (with a ``digest``), where no
    text takes part at all.

    ``product_version='load'`` (default) binds a review to the product
    version current at load time; ``'event'`` binds it to the version valid
    at the review's timestamp (:func:`bind_versions`).
    """
    if product_version not in ("load", "event"):
        raise ValueError("product_version must be 'load' or 'event'")
    r = reviews.select(
        F.col("r_reviewer_source_key").alias("_rsk"), F.col("r_product_key").alias("_psk"),
        descriptor_hash("r_review_text", "r_review_title").alias("_h"),
        F.col("r_review_text").alias("_text"), F.col("r_review_title").alias("_title"),
        F.coalesce(F.col("r_review_date_key"), F.lit(UNKNOWN_DATE_KEY)).alias("date_reviewed_key"),
        F.col("r_review_datetime").cast("timestamp_ntz").alias("_ts"),
        F.col("r_helpfulness_rating").cast("double").alias("helpfulness_rating"),
        F.col("r_review_score").cast("double").alias("review_rating"))
    product_dim = current_products(product_dim) if product_version == "load" else product_versions_at(product_dim)
    rest = [c for c in r.columns if c not in ("_text", "_title")]
    if "digest" in junk_dim.columns:
        j = _with_descriptors(r, junk_dim, rest)
    else:
        j = _with_descriptor_texts(r, junk_dim, rest)
    rv = reviewer_dim.select(F.col("reviewer_source_key").alias("_rsk"), "reviewer_key")
    dd = F.broadcast(date_dim.select(F.col("date_key").alias("_dk")).distinct())
    j = j.join(rv, "_rsk", "left")
    if product_version == "load":
        j = j.join(product_dim.select(F.col("product_source_key").alias("_psk"), "product_key"), "_psk", "left")
    else:
        j = bind_versions(j, product_dim, counted=r)
    j = j.join(dd, F.col("date_reviewed_key") == F.col("_dk"), "left")
    reason = (F.when(F.col("reviewer_key").isNull(), F.lit(MISSING_REVIEWER))
              .when(F.col("product_key").isNull(), F.lit(MISSING_PRODUCT))
              .when(F.col("review_descriptors_key").isNull(), F.lit(MISSING_DESCRIPTORS))
              .when(F.col("_dk").isNull(), F.lit(MISSING_DATE)))
    return j.select("_rsk", "_psk", *FACT_COLUMNS, "_dk", reason.alias(REASON))


def _with_descriptors(r: DataFrame, keys: DataFrame, rest: list[str]) -> DataFrame:
    """Descriptor keys by hash and digest: a plain join of narrow rows with a stored table of unique pairs.

    No text is shuffled, and the table is no aggregate, so adaptive execution can
    split the reviews of a hot descriptor (the blank text, say) over several tasks.
    """
    k = keys.select(F.col("descriptor_hash").alias("_h"), F.col("digest").alias("_d"), "review_descriptors_key")
    return r.withColumn("_d", descriptor_digest("_text", "_title")).select(*rest, "_d").join(k, ["_h", "_d"], "left").drop("_d")


def _with_descriptor_texts(r: DataFrame, junk_dim: DataFrame, rest: list[str]) -> DataFrame:
    """Descriptor keys by hash, on the texts where the dimension has several texts of one hash."""
    unique, collided = descriptor_lookup(junk_dim)
    by_hash = r.select(*rest).join(unique.withColumnRenamed("descriptor_hash", "_h"), "_h", "left")
    # Reviews whose hash collides in the dimension are matched on hash + both
    # texts; without any such hash no review text is shuffled.
    hashes = collided.select(F.col("descriptor_hash").alias("_h")).distinct()
    if not hashes.isEmpty():
        suspects = r.join(hashes, "_h", "left_semi")
        coll = collided.select(F.col("descriptor_hash").alias("_jh"), F.col("review_text").alias("_jt"),
                               F.col("review_title").alias("_jti"),
                               F.col("review_descriptors_key").alias("_ck"))
        coll_keys = (suspects.join(coll, (F.col("_h") == F.col("_jh")) & (F.col("_text") == F.col("_jt"))
                                   & (F.col("_title") == F.col("_jti")), "inner")
                     .select("_rsk", "_psk", "_h", "date_reviewed_key", "_ck"))
        by_hash = (by_hash.join(coll_keys, ["_rsk", "_psk", "_h", "date_reviewed_key"], "left")
                   .withColumn("review_descriptors_key", F.coalesce("review_descriptors_key", "_ck"))
                   .drop("_ck"))
    return by_hash


HOT_SHARE = 1000  # a key and month with over a thousandth of the reviews is dealt over several tasks


def bind_versions(reviews: DataFrame, versions: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Adds the ``product_key`` of the version of ``_psk`` valid at ``_ts`` (null where there is none).

    An as-of merge: versions and reviews of a key are put in order of time and the
    last version carried forward, so the work is rows, not reviews times versions.
    A key is cut into months, so that one product's reviews spread over tasks: each
    month with reviews gets the versions that start in it and the one that is valid
    as it begins.  A month that holds over ``1 / HOT_SHARE`` of all reviews is dealt
    over several tasks, each with the month's versions; counts add up to the total,
    so fewer than ``HOT_SHARE`` months are that hot and their list is broadcast.

    A review without a time binds to a key's version only if that is its only one.

    ``counted`` has the ``_psk`` and ``_ts`` of ``reviews`` as they were before joins that
    keep every row: months are counted there, so that the joins run once.
    """
    month = F.coalesce(F.year("_at") * 12 + F.month("_at"), F.lit(0))

    def sliced(df: DataFrame) -> DataFrame:
        return df.withColumn("_at", F.col("_ts")).withColumn("_slice", month).drop("_at")
    timed = sliced(reviews)
    met = timed if counted is None else sliced(counted.select("_psk", "_ts"))
    slices = materialize(met.groupBy("_psk", "_slice").agg(F.count(F.lit(1)).alias("_n")))
    total = slices.agg(F.sum("_n")).first()[0] or 0
    v = versions.select(F.col("product_source_key").alias("_psk"), "product_key", "_valid_from", "_valid_to")

    # The version valid as a month begins: months and versions of a key in order of time, both narrow.
    begin = F.make_timestamp_ntz(F.expr("(_slice - 1) div 12"), F.expr("(_slice - 1) % 12 + 1"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    held = F.struct("product_key", "_valid_to")
    none = F.lit(None).cast("struct<product_key:bigint,_valid_to:timestamp_ntz>")
    starts = v.select("_psk", F.col("_valid_from").alias("_at"), F.lit(0).alias("_kind"), held.alias("_v"), F.lit(None).cast("int").alias("_slice"))
    months = slices.filter("_slice > 0").select("_psk", begin.alias("_at"), F.lit(1).alias("_kind"), none.alias("_v"), "_slice")
    order = Window.partitionBy("_psk").orderBy(F.asc_nulls_first("_at"), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = starts.unionByName(months).withColumn("_v", F.last("_v", ignorenulls=True).over(order)) \
        .filter("_kind = 1 AND _v IS NOT NULL").select("_psk", "_slice", F.lit(None).cast("timestamp_ntz").alias("_at"), "_v")
    within = v.filter("_valid_from IS NOT NULL").select("_psk", F.col("_valid_from").alias("_at"), held.alias("_v")) \
        .withColumn("_slice", month).join(slices.select("_psk", "_slice"), ["_psk", "_slice"], "left_semi")
    only = v.filter("_valid_from IS NULL AND _valid_to IS NULL").select("_psk", F.lit(0).alias("_slice"),
                                                                       F.lit(None).cast("timestamp_ntz").alias("_at"), held.alias("_v"))
    marks = carried.unionByName(within).unionByName(only)

    deals = F.ceil(F.col("_n") * F.lit(float(HOT_SHARE)) / F.lit(float(total or 1))).cast("int")
    hot = F.broadcast(slices.filter(F.col("_n") * F.lit(HOT_SHARE) > F.lit(total)).select("_psk", "_slice", deals.alias("_deals")))
    def dealt(df: DataFrame, deal: Column) -> DataFrame:
        return df.join(hot, ["_psk", "_slice"], "left").withColumn("_deals", F.coalesce("_deals", F.lit(1))).withColumn("_deal", deal).drop("_deals")
    every = dealt(marks, F.explode(F.sequence(F.lit(0), F.col("_deals") - 1)))
    rows = dealt(timed, F.pmod(F.xxhash64("_rsk", "_h", "_ts"), F.col("_deals")).cast("int"))
    payload = F.struct(*[F.col(c) for c in reviews.columns])
    rows = rows.select("_psk", "_slice", "_deal", F.col("_ts").alias("_at"), F.lit(1).alias("_kind"), none.alias("_v"), payload.alias("_r"))
    every = every.select("_psk", "_slice", "_deal", "_at", F.lit(0).alias("_kind"), "_v",
                         F.lit(None).cast(rows.schema["_r"].dataType).alias("_r"))
    order = Window.partitionBy("_psk", "_slice", "_deal").orderBy(F.asc_nulls_first("_at"), "_kind") \
        .rowsBetween(Window.unboundedPreceding, 0)
    bound = every.unionByName(rows).withColumn("_v", F.last("_v", ignorenulls=True).over(order)).filter("_kind = 1")
    valid = F.col("_v._valid_to").isNull() | (F.col("_at") < F.col("_v._valid_to"))
    return bound.select("_r.*", F.when(valid, F.col("_v.product_key")).alias("product_key"))


def load_fact(reviews: DataFrame, reviewer_dim: DataFrame, product_dim: DataFrame,
              junk_dim: DataFrame, date_dim: DataFrame, existing: DataFrame | None = None,
              resolved: DataFrame | None = None, product_version: str = "load", unique: Observation | None = None
              ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (rows to append, quarantined rows, counts).

    Rows are unique, and tested against ``existing``, on :data:`FACT_GRAIN`:
    stored product keys are mapped back to source keys over all versions of
    ``product_dim``, so a review already loaded under an older version of its
    product is not loaded again.

    ``counts`` has ``records_in``, ``unresolved`` and ``records_failed`` (unresolved
    rows and those that lose their key to another row, exact copies among
    them).  Pass ``resolved`` (the output of :func:`resolve_fact_keys`, e.g.
    written once by the pipeline); without it they are written here, so that the
    outputs share one resolution pass.
    ``unique`` observes the number of rows (``rows``) that are left one a key,
    before those already loaded go.
    """
    j = resolved if resolved is not None else materialize(resolve_fact_keys(
        reviews, reviewer_dim, product_dim, junk_dim, date_dim, product_version))
    cols = [F.col("_rsk").alias("r_reviewer_source_key"), F.col("_psk").alias("r_product_key"),
            "date_reviewed_key", REASON]
    unresolved = j.filter(F.col(REASON).isNotNull()).select(*cols)
    found = j.filter(F.col(REASON).isNull()).select("_rsk", "_psk", *FACT_COLUMNS)
    # Several reviews on one key: keep the best-rated one, ties by smallest row.
    kept, dups = dedupe_on_key(found, FACT_GRAIN, prefer=[-F.coalesce("review_rating", F.lit(-1e300))])
    if unique is not None:
        kept = kept.observe(unique, F.count(F.lit(1)).alias("rows"))
    if existing is not None:
        versions = product_dim.select("product_key", F.col("product_source_key").alias("_psk"))
        loaded = existing.select(*FACT_PK).join(versions, "product_key").select(*FACT_GRAIN)
        kept = kept.join(loaded, FACT_GRAIN, "left_anti")
    ok = F.col(REASON).isNull()
    per_key = j.groupBy(ok.alias("_ok"), *[F.when(ok, F.col(c)).alias(c) for c in FACT_GRAIN]) \
        .agg(F.count(F.lit(1)).alias("_n"))
    counts = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("records_in"),
        F.coalesce(F.sum(F.when(~F.col("_ok"), F.col("_n"))), F.lit(0)).alias("unresolved"),
        F.coalesce(F.sum(F.when(F.col("_ok"), F.col("_n") - 1).otherwise(F.col("_n"))), F.lit(0)).alias("records_failed"))
    return kept.select(*FACT_COLUMNS), unresolved.unionByName(dups.select(*cols)), counts
