"""Dimension loaders: date (L2), category (L3), SCD1 (L4), SCD2 (L5, L5b),
junk (L7) and unknown members (L11).

Most loaders are pure functions ``(existing, incoming, …) → (new dimension,
counts)``, with counts as one-row aggregates.  :func:`scd1_apply` and
:func:`scd2_apply` apply the same rules to a stored
:class:`~starloom.sources.buckets.BucketTable`, so that a batch costs what its
changes cost; the persisted load (:mod:`starloom.plans.pipeline`) uses those.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.text import REVIEW_DEFAULTS
from ..session import materialize
from ..sources.buckets import BucketTable
from .joins import restrict_to_keys
from .keys import assign_surrogate_keys, max_key

DATE_COLUMNS = ["date_key", "date", "day_of_week", "month_of_year", "month_of_year_number",
                "day_of_month", "year", "quarter", "date_description"]

# The default calendar range of the date dimension and the
# reserved keys of unknown members.
DATE_START, DATE_YEARS = "2000-01-01", 30
UNKNOWN_DATE_KEY, UNKNOWN_MEMBER_KEY = 19000101, -1
UNKNOWN_DATE = "*Unknown Date"


def _date_attrs(df: DataFrame, c: str = "date") -> DataFrame:
    parts = D.date_parts(c)
    return df.select(
        D.date_key(c).alias("date_key"), F.col(c).alias("date"),
        parts["day_of_week"].alias("day_of_week"), parts["month_of_year"].alias("month_of_year"),
        parts["month_of_year_number"].alias("month_of_year_number"),
        parts["day_of_month"].alias("day_of_month"), parts["year"].alias("year"),
        parts["quarter"].alias("quarter"), D.date_description(c).alias("date_description"))


def _add_years(d: _dt.date, years: int) -> _dt.date:
    y = d.year + years
    try:
        return d.replace(year=y)
    except ValueError:  # Feb 29 → Feb 28, as INTERVAL arithmetic clamps
        return d.replace(year=y, day=28)


def build_date_dim(spark: SparkSession, start: str = DATE_START, years: int = DATE_YEARS) -> DataFrame:
    """L2: one row per day from ``start`` to ``start + years`` inclusive."""
    s = _dt.date.fromisoformat(start)
    n = (_add_years(s, years) - s).days + 1
    days = spark.range(0, n, numPartitions=max(1, min(64, n // 4096 + 1)))
    return _date_attrs(days.select(F.date_add(F.lit(s), F.col("id").cast("int")).alias("date")))


def date_dim_covering(df: DataFrame, c: str) -> DataFrame:
    """L2 sized by data: whole calendar years from the first to the last date in ``c``.

    The span is one aggregate row; the exploded calendar is bounded by the
    number of days in the span, not by the data volume.
    """
    span = df.agg(F.min(F.to_date(c)).alias("lo"), F.max(F.to_date(c)).alias("hi"))
    days = span.select(D.day_series(F.trunc("lo", "year"),
                                    F.date_add(F.add_months(F.trunc("hi", "year"), 12), -1)).alias("date"))
    return _date_attrs(days)


def unknown_date_member(spark: SparkSession) -> DataFrame:
    """Reserved date row (key 19000101), for reviews without a date."""
    return _date_attrs(spark.range(1).select(F.lit(_dt.date(1900, 1, 1)).alias("date"))) \
        .withColumn("date_description", F.lit(UNKNOWN_DATE))


def unknown_reviewer_member(spark: SparkSession) -> DataFrame:
    """Reserved reviewer row (key -1), for reviews without a reviewer id."""
    return spark.range(1).select(F.lit(UNKNOWN_MEMBER_KEY).cast("long").alias("reviewer_key"),
                                 F.lit(REVIEW_DEFAULTS["reviewer_source_key"]).alias("reviewer_source_key"),
                                 F.lit(REVIEW_DEFAULTS["reviewer_name"]).alias("reviewer_name"))


def known_reviewers(rows: DataFrame) -> DataFrame:
    """Reviewer rows with an id; the others belong to the unknown member, whose name stays."""
    return rows.filter(F.col("reviewer_source_key") != REVIEW_DEFAULTS["reviewer_source_key"])


def load_category(existing: DataFrame | None, names: DataFrame, name_col: str = "product_category"
                  ) -> tuple[DataFrame, DataFrame]:
    """L3: add category names not yet present, keys continuing from the maximum.

    Returns (new dimension, newly added rows).
    """
    incoming = names.select(F.col(name_col).alias("product_category")).filter(
        F.col("product_category").isNotNull()).distinct()
    if existing is not None:
        incoming = incoming.join(existing.select("product_category"), "product_category", "left_anti")
    added = assign_surrogate_keys(incoming, ["product_category"], "category_key",
                                  start_after=max_key(existing, "category_key"))
    added = added.select("category_key", "product_category")
    dim = added if existing is None else existing.select("category_key", "product_category").unionByName(added)
    return dim, added


def latest_per_key(df: DataFrame, key: str, attr: str, ts: str) -> DataFrame:
    """One (key, attr) per key: the value with the newest ``ts``, ties to the largest value.

    ``max_by`` is a partial aggregate, so a hot key is combined map-side.
    """
    return df.groupBy(key).agg(F.max_by(F.col(attr), F.struct(F.col(ts), F.col(attr))).alias(attr))


def scd1_upsert(existing: DataFrame | None, incoming: DataFrame, key: str = "reviewer_source_key",
                attr: str = "reviewer_name", ts: str = "review_datetime",
                sk: str = "reviewer_key") -> tuple[DataFrame, DataFrame]:
    """L4: overwrite ``attr`` in place for known keys; insert new keys.

    ``incoming`` may hold several rows per key; the newest by ``ts`` wins (D8).
    Returns (new dimension, counts with ``records_in``, ``type_1``, ``dim_new``).
    """
    # Batch-sized and read by several steps below: computed once.
    latest = materialize(latest_per_key(incoming, key, attr, ts).select(key, F.col(attr).alias("_new")))
    if existing is None:
        existing = latest.select(F.lit(None).cast("long").alias(sk), key, F.col("_new").alias(attr)).filter(F.lit(False))
    old = existing.select(F.col(sk), F.col(key), F.col(attr).alias("_old"))
    upd = old.join(latest, key, "left")
    kept = upd.select(sk, key, F.coalesce("_new", "_old").alias(attr))
    known = restrict_to_keys(old.select(key), key, latest, key)
    fresh = latest.join(known, key, "left_anti")
    added = assign_surrogate_keys(fresh.select(key, F.col("_new").alias(attr)), [key], sk,
                                  start_after=max_key(existing, sk)).select(sk, key, attr)
    dim = kept.unionByName(added)
    changed = upd.filter(F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("_old")))
    tagged = (latest.select(F.lit("in").alias("_t"))
              .unionByName(changed.select(F.lit("type_1").alias("_t")))
              .unionByName(fresh.select(F.lit("new").alias("_t"))))
    counts = tagged.agg(F.count(F.when(F.col("_t") == "in", 1)).alias("records_in"),
                        F.count(F.when(F.col("_t") == "type_1", 1)).alias("type_1"),
                        F.count(F.when(F.col("_t") == "new", 1)).alias("dim_new"))
    return dim, counts


def scd1_apply(table: BucketTable, incoming: DataFrame, batch_id: int, attr: str = "reviewer_name", ts: str = "review_datetime",
               sk: str = "reviewer_key", reserved: DataFrame | None = None) -> dict[str, int]:
    """L4 on a stored dimension: only buckets with a new or changed key are read further and written.

    ``reserved`` rows (L11) enter with the first commit.  Returns the counts
    ``records_in``, ``type_1``, ``dim_new``.
    """
    key, state = table.key, table.state()
    old = table.rows(table.touched(incoming)).select(key, F.col(sk).alias("_sk"), F.col(attr).alias("_old"))
    j = latest_per_key(incoming, key, attr, ts).join(old, key, "left").select(
        key, attr, F.when(F.col("_sk").isNull(), F.lit("new")).when(~F.col(attr).eqNullSafe(F.col("_old")), F.lit("type_1"))
        .otherwise(F.lit("same")).alias("_change"), table.bucket().alias("_bucket"))
    j = materialize(j)
    done = {(r["_bucket"], r["_change"]): r["count"] for r in j.groupBy("_bucket", "_change").count().collect()}
    counts = {"records_in": sum(done.values()), "type_1": sum(n for (_, c), n in done.items() if c == "type_1"),
              "dim_new": sum(n for (_, c), n in done.items() if c == "new")}
    touched = sorted({b for b, c in done if c != "same"})
    first = reserved is not None and not state.version
    if first:
        touched = sorted({*touched, *table.touched(reserved)})
    if not touched:
        return counts
    added = assign_surrogate_keys(j.filter(F.col("_change") == "new").select(key, attr), [key], sk, start_after=state.top)
    renamed = j.filter(F.col("_change") == "type_1").select(key, F.col(attr).alias("_new"))
    kept = table.rows(touched).join(renamed, key, "left").select(sk, key, F.coalesce("_new", attr).alias(attr))
    rows = kept.unionByName(added.select(sk, key, attr))
    table.commit(batch_id, rows.unionByName(reserved.select(sk, key, attr)) if first else rows, touched,
                 top=state.top + counts["dim_new"])
    return counts


def _changed(attrs: Sequence[str], left: str, right: str) -> Column:
    cond = F.lit(False)
    for a in attrs:
        cond = cond | ~F.col(f"{left}{a}").eqNullSafe(F.col(f"{right}{a}"))
    return cond


def scd2_merge(dim: DataFrame | None, snapshot: DataFrame, key: str, attrs: Sequence[str],
               as_of: str, sk: str = "product_key", change: str = "diff"
               ) -> tuple[DataFrame, DataFrame]:
    """Type-2 merge of one snapshot (one row per ``key``) into ``dim``.

    * new key → inserted current;
    * changed attributes (null-safe, ``change='diff'``) or any matched key
      (``change='always'``, the literal behaviour) → current row expires at
      ``as_of`` and a new current version is inserted;
    * keys absent from the snapshot stay as they are (no delete detection).

    Only current rows take part in the comparison; history rows pass
    through.  Returns (new dimension, counts ``records_in``, ``type_2``,
    ``dim_new``, ``unchanged``).
    """
    if change not in ("diff", "always"):
        raise ValueError("change must be 'diff' or 'always'")
    as_of_ts = F.lit(as_of).cast("timestamp_ntz")
    snap = snapshot.select(key, *attrs)
    cols = [sk, key, *attrs, "effective_date", "expiration_date", "is_current"]
    if dim is None:
        cur = snap.filter(F.lit(False)).select(F.lit(None).cast("long").alias(sk), *snap.columns)
        dim_all = None
    else:
        dim_all = dim.select(*cols)
        # Only current rows of keys in this snapshot can change.
        cur = restrict_to_keys(dim_all.filter("is_current").select(sk, key, *attrs), key, snap, key)
    old = cur.select(F.col(key), F.col(sk), *[F.col(a).alias(f"_o_{a}") for a in attrs])
    j = snap.join(old, key, "left")
    diff = F.lit(True) if change == "always" else _changed(attrs, "", "_o_")
    j = materialize(j.withColumn("_change", F.when(F.col(sk).isNull(), F.lit("new"))
                                 .when(diff, F.lit("type_2")).otherwise(F.lit("same"))))
    inserts = j.filter(F.col("_change") != "same").select(key, *attrs)
    added = assign_surrogate_keys(inserts, [key], sk, start_after=max_key(dim, sk)).select(
        sk, key, *attrs, as_of_ts.alias("effective_date"),
        F.lit(None).cast("timestamp_ntz").alias("expiration_date"), F.lit(True).alias("is_current"))
    counts = j.agg(F.count(F.lit(1)).alias("records_in"),
                   F.sum(F.when(F.col("_change") == "type_2", 1).otherwise(0)).cast("long").alias("type_2"),
                   F.sum(F.when(F.col("_change") == "new", 1).otherwise(0)).cast("long").alias("dim_new"),
                   F.sum(F.when(F.col("_change") == "same", 1).otherwise(0)).cast("long").alias("unchanged"))
    if dim_all is None:
        return added.select(*cols), counts
    expiring = j.filter(F.col("_change") == "type_2").select(F.col(sk).alias("_exp_sk"))
    marked = dim_all.join(expiring, F.col(sk) == F.col("_exp_sk"), "left")
    hit = F.col("_exp_sk").isNotNull() & F.col("is_current")
    kept = marked.select(
        sk, key, *attrs, "effective_date",
        F.when(hit, as_of_ts).otherwise(F.col("expiration_date")).alias("expiration_date"),
        F.when(hit, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"))
    return kept.unionByName(added.select(*cols)), counts


def scd2_apply(table: BucketTable, snapshot: DataFrame, attrs: Sequence[str], as_of: str, batch_id: int,
               sk: str = "product_key", change: str = "diff") -> dict[str, int]:
    """L5 on a stored dimension: current versions in buckets, expired ones append-only.

    The rule is :func:`scd2_merge`'s.  Buckets without a new or changed key keep
    their files, and no batch reads or writes the versions that expired before it.
    Returns the counts ``records_in``, ``type_2``, ``dim_new``, ``unchanged``.
    """
    if change not in ("diff", "always"):
        raise ValueError("change must be 'diff' or 'always'")
    key, state, as_of_ts = table.key, table.state(), F.lit(as_of).cast("timestamp_ntz")
    snap = snapshot.select(key, *attrs)
    old = table.rows(table.touched(snap)).select(key, F.col(sk).alias("_sk"), F.col("effective_date").alias("_from"),
                                                 *[F.col(a).alias(f"_o_{a}") for a in attrs])
    differs = F.lit(True) if change == "always" else _changed(attrs, "", "_o_")
    j = materialize(snap.join(old, key, "left").withColumn(
        "_change", F.when(F.col("_sk").isNull(), F.lit("new")).when(differs, F.lit("type_2")).otherwise(F.lit("same")))
        .withColumn("_bucket", table.bucket()))
    done = {(r["_bucket"], r["_change"]): r["count"] for r in j.groupBy("_bucket", "_change").count().collect()}
    total = {c: sum(n for (_, x), n in done.items() if x == c) for c in ("new", "type_2", "same")}
    counts = {"records_in": sum(total.values()), "type_2": total["type_2"], "dim_new": total["new"], "unchanged": total["same"]}
    touched = sorted({b for b, c in done if c != "same"})
    if not touched:
        return counts
    moved = j.filter(F.col("_change") != "same")
    version = [as_of_ts.alias("effective_date"), F.lit(None).cast("timestamp_ntz").alias("expiration_date"), F.lit(True).alias("is_current")]
    added = assign_surrogate_keys(moved.select(key, *attrs), [key], sk, start_after=state.top).select(sk, key, *attrs, *version)
    kept = table.rows(touched).join(moved.select(F.col(key).alias("_moved")), F.col(key) == F.col("_moved"), "left_anti")
    expired = moved.filter(F.col("_change") == "type_2").select(
        F.col("_sk").alias(sk), key, *[F.col(f"_o_{a}").alias(a) for a in attrs], F.col("_from").alias("effective_date"),
        as_of_ts.alias("expiration_date"), F.lit(False).alias("is_current"))
    table.commit(batch_id, kept.select(*added.columns).unionByName(added), touched, expired if counts["type_2"] else None,
                 top=state.top + counts["dim_new"] + counts["type_2"])
    return counts


def scd2_history(log: DataFrame, key: str, attrs: Sequence[str], as_of_col: str = "as_of",
                 sk: str = "product_key") -> DataFrame:
    """The whole type-2 history from a log of snapshots in one pass.

    Per key, snapshots are ordered by ``as_of``; a version starts where the
    attributes differ from the previous snapshot *that contained the key*
    and expires at the next version's start.  Equal to folding
    :func:`scd2_merge` (``diff``) over the snapshots in order, keys included.

    The window partitions by natural key; a key has at most one row per
    snapshot, so the partition size is bounded by the number of snapshots.
    """
    w = Window.partitionBy(key).orderBy(as_of_col)
    prev = [F.lag(F.col(a)).over(w).alias(f"_p_{a}") for a in attrs]
    staged = log.select(key, *attrs, as_of_col, F.lag(F.col(as_of_col)).over(w).alias("_p_asof"), *prev)
    starts = staged.filter(F.col("_p_asof").isNull() | _changed(attrs, "", "_p_"))
    w2 = Window.partitionBy(key).orderBy(as_of_col)
    versions = starts.select(
        key, *attrs, F.col(as_of_col).cast("timestamp_ntz").alias("effective_date"),
        F.lead(F.col(as_of_col)).over(w2).cast("timestamp_ntz").alias("expiration_date"))
    versions = versions.withColumn("is_current", F.col("expiration_date").isNull())
    # Numbered by (start, key): the order a snapshot-by-snapshot merge uses.
    keyed = assign_surrogate_keys(versions, ["effective_date", key], sk)
    return keyed.select(sk, key, *attrs, "effective_date", "expiration_date", "is_current")


def descriptor_hash(text: str | Column, title: str | Column) -> Column:
    """P17 for the junk dimension: md5 of the two md5s (no separator ambiguity)."""
    t = F.col(text) if isinstance(text, str) else text
    ti = F.col(title) if isinstance(title, str) else title
    return F.md5(F.concat(F.md5(t), F.md5(ti)))


def descriptor_digest(text: str | Column, title: str | Column) -> Column:
    """Identity of a (text, title) pair beside its md5: SHA-256 of both, the title after the text's length."""
    t = F.col(text) if isinstance(text, str) else text
    ti = F.col(title) if isinstance(title, str) else title
    return F.unhex(F.sha2(F.concat(F.length(t).cast("string"), F.lit(":"), t, ti).cast("binary"), 256))


def new_descriptors(reviews: DataFrame, stored: DataFrame | None, start_after: int, text: str = "review_text",
                    title: str = "review_title") -> tuple[DataFrame, DataFrame]:
    """L7 on narrow rows: (new keys by hash and digest, the new descriptors with their texts).

    Which pairs are new, and their keys, are decided on ``descriptor_hash, digest``
    (48 bytes a pair; ``stored`` has those of earlier batches).  Texts are then
    shuffled once, by the same two columns, one text a pair after the map side.
    """
    ident = ["descriptor_hash", "digest"]
    pairs = reviews.select(descriptor_hash(text, title).alias("descriptor_hash"), descriptor_digest(text, title).alias("digest"),
                           F.col(text).alias("review_text"), F.col(title).alias("review_title"))
    fresh = pairs.select(*ident).distinct()
    if stored is not None:
        fresh = fresh.join(stored.select(*ident), ident, "left_anti")
    keys = assign_surrogate_keys(fresh, ident, "review_descriptors_key", start_after=start_after)
    keys = materialize(keys.select("review_descriptors_key", *ident))
    texts = pairs.groupBy(*ident).agg(F.first(F.struct("review_text", "review_title")).alias("_t"))
    rows = texts.join(keys, ident).select("review_descriptors_key", "_t.review_text", "_t.review_title", "descriptor_hash")
    return keys, rows


def load_junk_dim(existing: DataFrame | None, reviews: DataFrame, text: str = "review_text",
                  title: str = "review_title") -> tuple[DataFrame, DataFrame]:
    """Distinct (text, title) combinations not yet present get a key.

    Keys are numbered in (hash, text, title) order; comparisons use the hash
    plus both columns (D4/D19), so equal texts with different titles stay
    apart.  Returns (new dimension, added rows).
    """
    pairs = reviews.select(F.col(text).alias("review_text"), F.col(title).alias("review_title")).distinct()
    pairs = materialize(pairs.withColumn("descriptor_hash", descriptor_hash("review_text", "review_title")))
    if existing is not None:
        # Only stored pairs sharing a hash with this batch can be equal; they are
        # picked out while the dimension is scanned, then compared exactly.
        ex = restrict_to_keys(existing.select("descriptor_hash", "review_text", "review_title"),
                              "descriptor_hash", pairs, "descriptor_hash")
        pairs = pairs.join(ex, ["descriptor_hash", "review_text", "review_title"], "left_anti")
    added = assign_surrogate_keys(pairs, ["descriptor_hash", "review_text", "review_title"],
                                  "review_descriptors_key",
                                  start_after=max_key(existing, "review_descriptors_key"))
    cols = ["review_descriptors_key", "review_text", "review_title", "descriptor_hash"]
    added = added.select(*cols)
    dim = added if existing is None else existing.select(*cols).unionByName(added)
    return dim, added


__all__ = ["build_date_dim", "date_dim_covering", "unknown_date_member", "unknown_reviewer_member", "known_reviewers",
           "load_category", "latest_per_key", "scd1_upsert", "scd2_merge", "scd2_history",
           "descriptor_hash", "descriptor_digest", "new_descriptors", "load_junk_dim", "scd1_apply", "scd2_apply", "DATE_COLUMNS"]
