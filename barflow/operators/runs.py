"""Metric history and experiment tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.sources.batches import append_batch, read_batches

METRIC_SCHEMA = "experiment string, seq bigint, step bigint, ts timestamp_ntz, name string, value double"
EVENT_SCHEMA = "experiment string, ts timestamp_ntz, status string"
STATUSES = ("running", "completed", "failed")


def metric_rows(metrics: DataFrame, experiment: str, seq: int, step: int | None, ts: str) -> DataFrame:
    """One-row wide metrics -> long rows of the metric table."""
    texts = metrics.select(*[F.col(c).cast("double").alias(c) for c in metrics.columns])
    long = texts.select(F.lit(1).alias("_"), "*").unpivot("_", list(metrics.columns), "name", "value")
    return long.select(
        F.lit(experiment).alias("experiment"),
        F.lit(seq).cast("bigint").alias("seq"),
        F.lit(step).cast("bigint").alias("step"),
        F.lit(ts).cast("timestamp_ntz").alias("ts"),
        "name",
        "value",
    )


def log_metrics(rows: DataFrame, path: str, batch: str) -> bool:
    """Append a named batch of metric rows; the same batch again changes nothing. Read them with ``metric_history``."""
    return append_batch(rows, path, batch)


def metric_history(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path).drop("batch")


def log_status(df: DataFrame, path: str, batch: str) -> bool:
    """Append a named batch of status events, once."""
    return append_batch(df, path, batch)


def metrics_summary(history: DataFrame, names: Sequence[str], keys: Sequence[str] = ("step", "ts")) -> DataFrame:
    """One row per logged entry, one column per metric name."""
    return history.groupBy(*keys).pivot("name", list(names)).agg(F.first("value", ignorenulls=True))


def final_metrics(history: DataFrame) -> DataFrame:
    """Last logged value per (experiment, name) among entries without a step or at the experiment's
    last step. All but the final join is one map-side combined aggregation."""
    per_name = history.groupBy("experiment", "name").agg(
        F.max("step").alias("top"),
        F.max(F.when(F.col("step").isNull(), F.col("seq"))).alias("free_seq"),
        F.max_by(
            F.when(F.col("step").isNull(), F.col("value")), F.when(F.col("step").isNull(), F.col("seq"))
        ).alias("free_value"),
        F.max(F.when(F.col("step").isNotNull(), F.struct("step", "seq", "value"))).alias("stepped"),
    )
    last = per_name.groupBy("experiment").agg(F.max("top").alias("last_step"))
    joined = per_name.join(last, "experiment")
    at_last = F.col("stepped.step") == F.col("last_step")
    stepped_seq = F.when(at_last, F.col("stepped.seq"))
    use_stepped = stepped_seq.isNotNull() & (F.col("free_seq").isNull() | (stepped_seq > F.col("free_seq")))
    value = F.when(use_stepped, F.col("stepped.value")).otherwise(F.col("free_value"))
    return joined.where(stepped_seq.isNotNull() | F.col("free_seq").isNotNull()).select(
        "experiment", "name", value.alias("value")
    )


def latest_status(events: DataFrame) -> DataFrame:
    """Start, end and the latest status of every experiment; no end while it is running."""
    found = events.groupBy("experiment").agg(
        F.min(F.when(F.col("status") == "running", F.col("ts"))).alias("start_time"),
        F.max(F.when(F.col("status") != "running", F.col("ts"))).alias("end_time"),
        F.max(F.struct("ts", "status"))["status"].alias("status"),
    )
    return found.withColumn("end_time", F.when(F.col("status") != "running", F.col("end_time")))


def experiment_summary(
    events: DataFrame, history: DataFrame, names: Sequence[str], artifacts: DataFrame | None = None, now: str | None = None
) -> DataFrame:
    """Per experiment: times, status, seconds (until ``now`` while running), counts, final metrics."""
    base = latest_status(events)
    until = F.coalesce("end_time", F.localtimestamp() if now is None else F.lit(now).cast("timestamp_ntz"))
    micros = F.expr("timestampdiff(MICROSECOND, start_time, _until)")
    base = base.withColumn("_until", until).withColumn("duration", micros / 1e6).drop("_until")
    counts = history.groupBy("experiment").agg(F.count(F.lit(1)).alias("num_metrics"))
    out = base.join(counts, "experiment", "left").fillna(0, ["num_metrics"])
    if artifacts is None:
        out = out.withColumn("num_artifacts", F.lit(0).cast("bigint"))
    else:
        kept = artifacts.groupBy("experiment").agg(F.count(F.lit(1)).alias("num_artifacts"))
        out = out.join(kept, "experiment", "left").fillna(0, ["num_artifacts"])
    finals = metrics_summary(final_metrics(history), names, ["experiment"])
    return out.join(finals, "experiment", "left")
