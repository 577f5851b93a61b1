"""Import audit (M1–M7, A5): an append-only event log and its latest state.

Instead of updating batch/process/task rows in place, every start, end and
failure appends an event.  The three audit tables are views over the log:
start = time of the first event, end and status = the newest event.
Counts of a task come from aggregates over the classified rows of that
task; the event row is projected from that one-row aggregate, so the
counts are never collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The status names.
RUNNING, COMPLETED, FAILED, ABORTED = "Running", "Completed", "Failed", "Aborted"
STATUSES = (RUNNING, COMPLETED, FAILED, ABORTED)
COUNT_COLUMNS = ["records_in", "records_failed", "records_out", "records_type_2", "records_type_1",
                 "records_dim_new"]

EVENT_SCHEMA = T.StructType([
    T.StructField("level", T.StringType()),        # batch | process | task
    T.StructField("id", T.LongType()),
    T.StructField("parent_id", T.LongType()),
    T.StructField("description", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in COUNT_COLUMNS],
    T.StructField("message", T.StringType()),
])


def events(rows: DataFrame, level: str, id_: Column, parent: Column | None, description: Column, status: Column,
           ts: Column, seq: Column, year: Column | None = None, month: Column | None = None,
           counts: dict[str, Column] | None = None, message: Column | None = None) -> DataFrame:
    """M1–M4 in bulk: one event per row of ``rows``, each field an expression over it.

    A status outside :data:`STATUSES` is an error when the row is read.
    """
    given = {"level": F.lit(level), "id": id_, "parent_id": parent, "description": description, "year": year,
             "month": month, "event_ts": ts, "seq": seq, "message": message, **(counts or {}),
             "status": F.when(status.isin(*STATUSES), status).otherwise(
                 F.raise_error(F.concat(F.lit("unknown status "), F.coalesce(status, F.lit("null")))))}
    return rows.select(*[(given[f.name] if given.get(f.name) is not None else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in EVENT_SCHEMA.fields])


def _event(spark: SparkSession, level: str, id_: int, parent: int | None, description: str,
           status: str, ts: str, seq: int, year: int | None = None, month: int | None = None,
           message: str | None = None) -> DataFrame:
    if status not in STATUSES:
        raise ValueError(f"unknown status {status!r}")
    return events(spark.range(1), level, F.lit(id_), F.lit(parent), F.lit(description), F.lit(status), F.lit(ts),
                  F.lit(seq), F.lit(year), F.lit(month), message=F.lit(message))


def batch_event(spark, ib_id, description, status, ts, seq, year=None, month=None, message=None):
    """M1/M2: a batch started or changed status."""
    return _event(spark, "batch", ib_id, None, description, status, ts, seq, year, month, message)


def process_event(spark, ibp_id, ib_id, description, status, ts, seq, message=None):
    """M3: a process of a batch started or changed status."""
    return _event(spark, "process", ibp_id, ib_id, description, status, ts, seq, message=message)


def task_event(counts: DataFrame | None, spark, ibpt_id, ibp_id, description, status, ts, seq,
               message=None) -> DataFrame:
    """M4: a task event; ``counts`` is a one-row aggregate with any of :data:`COUNT_COLUMNS`.

    The event is projected from the counts row itself, so the counts stay
    a Spark aggregate and nothing is collected.
    """
    base = _event(spark, "task", ibpt_id, ibp_id, description, status, ts, seq, message=message)
    if counts is None:
        return base
    counted = [(F.col(n) if n in counts.columns else F.lit(None)).cast("long").alias(n) for n in COUNT_COLUMNS]
    literals = [c for c in base.columns if c not in COUNT_COLUMNS and c != "message"]
    return counts.select(*[F.lit(base_value).alias(name) for name, base_value in zip(literals, (
        "task", ibpt_id, ibp_id, description, None, None, status, ts, seq))], *counted,
        F.lit(message).cast("string").alias("message")) \
        .select(*[F.col(f.name).cast(f.dataType) for f in EVENT_SCHEMA.fields])


def outcome_counts(classified: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    """A5: records in / failed / out of a row-preserving task, one aggregate."""
    return classified.agg(F.count(F.lit(1)).alias("records_in"),
                          F.count(F.col(reason_col)).alias("records_failed"),
                          F.count(F.when(F.col(reason_col).isNull(), 1)).alias("records_out"))


def latest_state(log: DataFrame) -> DataFrame:
    """Current row per (level, id): first event's time as start, newest event's status.

    An aggregate per id (partial ``max_by``), not a window.
    """
    order = F.struct("event_ts", "seq")
    described = F.when(F.col("description").isNotNull(), order)  # the oldest event that has a description
    newest = F.max_by(F.struct(*[c for c in EVENT_SCHEMA.fieldNames() if c not in ("level", "id")]), order)
    g = log.groupBy("level", "id").agg(newest.alias("n"), F.min("event_ts").alias("start_ts"),
                                       F.min_by("description", described).alias("first_description"),
                                       *[F.max(c).alias(f"max_{c}") for c in ("year", "month", "parent_id")])
    status = F.col("n.status")
    return g.select(
        "level", "id", F.col("max_parent_id").alias("parent_id"),
        F.coalesce("first_description", "n.description").alias("description"),
        F.col("max_year").alias("year"), F.col("max_month").alias("month"),
        F.col("start_ts").alias("start_ts"),
        F.when(status != RUNNING, F.col("n.event_ts")).alias("end_ts"), status.alias("status"),
        *[F.col(f"n.{c}").alias(c) for c in COUNT_COLUMNS], F.col("n.message").alias("message"))


def import_batch(log: DataFrame) -> DataFrame:
    """The ``import_batch`` table as of the log."""
    s = latest_state(log).filter(F.col("level") == "batch")
    return s.select(F.col("id").alias("ib_id"), F.col("description").alias("ib_description"),
                    F.col("year").alias("ib_year"), F.col("month").alias("ib_month"),
                    F.col("start_ts").alias("ib_start"), F.col("end_ts").alias("ib_end"),
                    F.col("status").alias("ib_status"))


def import_batch_process(log: DataFrame) -> DataFrame:
    s = latest_state(log).filter(F.col("level") == "process")
    return s.select(F.col("id").alias("ibp_id"), F.col("parent_id").alias("ib_id"),
                    F.col("description").alias("ib_description"), F.col("start_ts").alias("ib_start"),
                    F.col("end_ts").alias("ib_end"), F.col("status").alias("ib_status"))


def import_batch_process_task(log: DataFrame) -> DataFrame:
    s = latest_state(log).filter(F.col("level") == "task")
    return s.select(F.col("id").alias("ibpt_id"), F.col("parent_id").alias("ibp_id"),
                    F.col("description").alias("ib_description"), F.col("start_ts").alias("ib_start"),
                    F.col("end_ts").alias("ib_end"), F.col("status").alias("ib_status"),
                    *[F.col(c).alias(f"ibpt_{c}") for c in COUNT_COLUMNS])


def latest_running_batch(log: DataFrame) -> DataFrame:
    """M6: id of the newest batch still Running (zero or one row)."""
    b = import_batch(log).filter(F.col("ib_status") == RUNNING)
    return b.orderBy(F.col("ib_start").desc(), F.col("ib_id").desc()).limit(1).select("ib_id")


def record_failure(log: DataFrame, ts: str, seq: int, message: str | None = None) -> DataFrame:
    """M5: ``Failed`` events for the newest Running task, its process and its batch.

    Returns the events to append (zero to three rows).
    """
    st = latest_state(log).filter(F.col("status") == RUNNING)
    cols = EVENT_SCHEMA.fieldNames()
    out = None
    for level in ("task", "process", "batch"):
        newest = st.filter(F.col("level") == level).orderBy(F.col("start_ts").desc(), F.col("id").desc()).limit(1)
        ev = newest.select(
            "level", "id", "parent_id", "description", "year", "month", F.lit(FAILED).alias("status"),
            F.lit(ts).cast("timestamp_ntz").alias("event_ts"), F.lit(seq).cast("long").alias("seq"),
            *[F.lit(None).cast("long").alias(c) for c in COUNT_COLUMNS],
            F.lit(message).cast("string").alias("message")).select(*cols)
        out = ev if out is None else out.unionByName(ev)
    return out


def import_statistics(log: DataFrame) -> DataFrame:
    """Q3: tasks of the newest batch (``ib_id = max``) with their process.

    The newest batch id is a one-row aggregate joined on equality.
    """
    batches = import_batch(log)
    latest = batches.agg(F.max("ib_id").alias("ib_id"))
    batch = batches.join(F.broadcast(latest), "ib_id")
    procs = import_batch_process(log).join(F.broadcast(latest), "ib_id")
    tasks = import_batch_process_task(log)
    return (tasks.join(procs.select("ibp_id", "ib_id", F.col("ib_description").alias("process_description"),
                                    F.col("ib_status").alias("process_status")), "ibp_id")
            .join(batch.select("ib_id", F.col("ib_description").alias("batch_description"),
                               F.col("ib_status").alias("batch_status")), "ib_id"))
