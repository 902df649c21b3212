"""Job states: classification, latest state per job, ledger rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise import fixed
from lotwise.functions.naming import job_id

EVENT_SCHEMA = "job_arn string, status string, event_ts timestamp, seq bigint"


def classify(status: Column) -> Column:
    """``success``, ``failure`` or ``heartbeat``; null for a state outside the list."""
    return (
        F.when(status.isin(*fixed.SUCCESS_STATUSES), "success")
        .when(status.isin(*fixed.FAILURE_STATUSES), "failure")
        .when(status.isin(*fixed.JOB_STATUSES), "heartbeat")
    )


def failure_message(status: Column) -> Column:
    """The state itself for failed jobs, else null."""
    return F.when(status.isin(*fixed.FAILURE_STATUSES), status)


def with_class(events: DataFrame) -> DataFrame:
    return events.withColumn("class", classify(F.col("status"))).withColumn(
        "error_message", failure_message(F.col("status"))
    )


def latest_status(events: DataFrame) -> DataFrame:
    """Latest state per job by (event time, sequence): an old event arriving late changes nothing.

    Also folds partial results of itself, so batches may be reduced before they are combined.
    """
    order = F.struct("event_ts", "seq")
    newest = F.max_by(F.struct("status", "event_ts", "seq"), order)
    return (
        events.groupBy("job_arn")
        .agg(newest.alias("newest"))
        .select("job_arn", "newest.status", "newest.event_ts", "newest.seq")
    )


def unknown_states(events: DataFrame) -> DataFrame:
    """Events whose state is not in the list."""
    return events.filter(classify(F.col("status")).isNull())


def ledger_rows(manifest: DataFrame, submissions: DataFrame) -> DataFrame:
    """First ledger row per submitted job: manifest fields joined to (job_name, job_arn, status)."""
    return manifest.join(submissions, "job_name").select(
        "job_arn",
        "model_id",
        "chunk_idx",
        "inputs_path",
        "outputs_path",
        "status",
        F.lit(None).cast("string").alias("error_message"),
    )


def join_ledger(events: DataFrame, ledger: DataFrame) -> DataFrame:
    """Events with their ledger row; ``known`` is false for jobs that are not ours."""
    rows = ledger.drop("status", "error_message").withColumn("__known", F.lit(True))
    return (
        events.join(rows, "job_arn", "left")
        .withColumn("known", F.coalesce(F.col("__known"), F.lit(False)))
        .drop("__known")
    )


def update_ledger(ledger: DataFrame, events: DataFrame) -> DataFrame:
    """Ledger with each job's latest known state; jobs without events keep their row.

    Events whose state is not in the list change nothing, however new they are.
    """
    known = events.filter(classify(F.col("status")).isNotNull())
    newest = with_class(latest_status(known)).select(
        "job_arn", F.col("status").alias("__status"), F.col("error_message").alias("__error")
    )
    seen = F.col("__status").isNotNull()
    return (
        ledger.join(newest, "job_arn", "left")
        .withColumn("status", F.when(seen, F.col("__status")).otherwise(F.col("status")))
        .withColumn("error_message", F.when(seen, F.col("__error")).otherwise(F.col("error_message")))
        .drop("__status", "__error")
    )


def collectable_jobs(ledger: DataFrame, accept_partial: bool = False) -> DataFrame:
    """Ids of jobs whose output is collected: completed and without an error message."""
    message = F.coalesce(F.col("error_message"), F.lit(""))
    done = F.coalesce(F.col("status").isin(*fixed.SUCCESS_STATUSES), F.lit(False)) & (message == "")
    if accept_partial:
        done = done | (F.col("status") == "PartiallyCompleted")
    return ledger.filter(done).select(job_id(F.col("job_arn")).alias("job_id"))


def ledger_states(ledger: DataFrame) -> DataFrame:
    """What collecting reads of a ledger: ``job_arn, status, error_message`` and, where it has one, ``chunk_idx``."""
    return ledger.select("job_arn", "status", "error_message", *(["chunk_idx"] if "chunk_idx" in ledger.columns else []))


def failure_windows(
    events: DataFrame,
    period: str = fixed.ALARM_PERIOD,
    threshold: int = fixed.ALARM_THRESHOLD,
    lateness: str = "10 minutes",
) -> DataFrame:
    """Periods with at least ``threshold`` failures. Works on tables and streams; quiet periods do not appear."""
    return (
        events.filter(classify(F.col("status")) == "failure")
        .withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", period))
        .agg(F.count(F.lit(1)).alias("n_failed"))
        .filter(F.col("n_failed") >= threshold)
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n_failed"
        )
    )
