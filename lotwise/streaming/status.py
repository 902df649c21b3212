"""Folding job-state events as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotwise.session import children, drop_path
from lotwise.operators.ledger import EVENT_SCHEMA, failure_windows, join_ledger, latest_status, with_class

LOG_SCHEMA = "job_arn string, status string, event_ts timestamp, seq bigint, epoch bigint"


def fold_events(events: DataFrame, log: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep each job's newest state in a log table.

    Every batch is reduced to one row per job and written to its own ``epoch``
    folder; a replayed batch replaces that folder. The newest state is associative,
    so reading folds the epochs and the stream itself holds no state.
    """

    def write_epoch(batch: DataFrame, epoch: int) -> None:
        latest_status(batch).write.mode("overwrite").parquet(f"{log}/epoch={epoch}")

    writer = events.writeStream.foreachBatch(write_epoch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def compact_log(spark: SparkSession, log: str) -> None:
    """Replace the epochs of a log by one that holds their newest states.

    The snapshot is written before what it covers is deleted, and folding twice changes
    nothing, so a failure in between and a replayed epoch do no harm.
    """
    epochs = children(spark, log)
    numbers = [int(e.removeprefix("epoch=")) for e in epochs if e.startswith("epoch=")]
    if len(numbers) < 2:
        return
    covered = [f"{log}/epoch={n}" for n in numbers]
    folded = latest_status(spark.read.schema(LOG_SCHEMA).option("basePath", log).parquet(*covered).drop("epoch"))
    # Snapshots count down from -1, epochs of the stream count up from 0.
    folded.write.mode("overwrite").parquet(f"{log}/epoch={min(0, *numbers) - 1}")
    for path in covered:
        drop_path(spark, path)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """Newest state per job over all epochs."""
    return latest_status(spark.read.schema(LOG_SCHEMA).parquet(log).drop("epoch"))


def route_events(
    events: DataFrame,
    ledger: DataFrame | Callable[[SparkSession], DataFrame],
    known: str,
    unknown: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Look up each event's ledger row: known jobs go to one table, others to quarantine.

    The ledger has one row per job; Spark picks the join by its size in each batch. For
    a stream that keeps running, give a function that reads it: it is called for every
    batch, so jobs that are submitted meanwhile are known. An event whose state is not in
    the list is quarantined too.
    """

    def write_epoch(batch: DataFrame, epoch: int) -> None:
        rows = ledger(batch.sparkSession) if callable(ledger) else ledger
        joined = join_ledger(with_class(batch), rows).withColumn(
            "accepted", F.col("known") & F.col("class").isNotNull()
        )
        joined.persist()
        try:
            joined.filter("accepted").drop("accepted").write.mode("overwrite").parquet(f"{known}/epoch={epoch}")
            joined.filter("not accepted").drop("accepted").write.mode("overwrite").parquet(
                f"{unknown}/epoch={epoch}"
            )
        finally:
            joined.unpersist()

    writer = events.writeStream.foreachBatch(write_epoch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def alarm_stream(
    events: DataFrame, alarms: str, checkpoint: str, available_now: bool = True, **options
) -> StreamingQuery:
    """Write each period with too many failures once the watermark has passed it."""
    writer = (
        failure_windows(events, **options)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", alarms)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_event_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Job-state events arriving as JSON files."""
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(path)
