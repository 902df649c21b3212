"""The ledger of a run as a table: a folder per version, the newest one counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotwise.operators.ledger import ledger_rows, update_ledger
from lotwise.session import children, drop_path

KEPT_VERSIONS = 2


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that were written to the end."""
    found = [int(n.removeprefix("version=")) for n in children(spark, path) if n.startswith("version=")]
    return sorted(v for v in found if "_SUCCESS" in children(spark, f"{path}/version={v}"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The newest version; a function of it suits streams, which read it anew for every batch."""
    versions = _versions(spark, path)
    if not versions:
        raise ValueError(f"no ledger at {path}")
    return spark.read.parquet(f"{path}/version={versions[-1]}")


def save_ledger(ledger: DataFrame, path: str) -> DataFrame:
    """Write a new version and forget all but the last ones; readers of the one before are not disturbed."""
    spark = ledger.sparkSession
    versions = _versions(spark, path)
    new = versions[-1] + 1 if versions else 0
    ledger.write.mode("overwrite").parquet(f"{path}/version={new}")
    for old in versions[: 1 - KEPT_VERSIONS]:
        drop_path(spark, f"{path}/version={old}")
    return read_ledger(spark, path)


def record_submissions(manifest: DataFrame, submissions: DataFrame, path: str) -> DataFrame:
    """Save the first ledger of a run from its manifest and the submitted jobs (``job_name, job_arn, status``)."""
    return save_ledger(ledger_rows(manifest, submissions), path)


def record_events(spark: SparkSession, events: DataFrame, path: str) -> DataFrame:
    """Save the ledger with the newest known state of each job."""
    return save_ledger(update_ledger(read_ledger(spark, path), events), path)
