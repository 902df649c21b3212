"""The log of finished model calls: a folder per run and wave, each counts once it is complete."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.session import children

OUTCOMES = "call_key string, answer string, error string, tries int"


def call_keys(body: Column, model: str = "") -> Column:
    """A name of a call: SHA-256 of the model and the request body."""
    return F.sha2(F.concat(F.lit(f"{len(model)}:{model}:"), body), 256)


def _runs(spark: SparkSession, log: str) -> list[int]:
    return sorted(int(n.removeprefix("run=")) for n in children(spark, f"{log}/done") if n.startswith("run="))


def complete_waves(spark: SparkSession, log: str) -> list[str]:
    """Folders of waves that were written to the end, oldest run first."""
    found = []
    for run in _runs(spark, log):
        for wave in children(spark, f"{log}/done/run={run}"):
            folder = f"{log}/done/run={run}/{wave}"
            if "_SUCCESS" in children(spark, folder):
                found.append(folder)
    return found


def finished_calls(spark: SparkSession, log: str) -> DataFrame:
    """One outcome per call, ``call_key, call`` (answer, error, tries, run): an answer if any run got one, else the
    newest error."""
    waves = complete_waves(spark, log)
    if not waves:
        rows = spark.createDataFrame([], f"{OUTCOMES}, run int")
    else:
        reader = spark.read.schema(f"{OUTCOMES}, run int, wave int").option("basePath", f"{log}/done")
        rows = reader.parquet(*waves)
    best = F.max_by(F.struct("answer", "error", "tries", "run"), F.struct(F.col("error").isNull(), "run"))
    return rows.groupBy("call_key").agg(best.alias("call"))


def pending_calls(requests: DataFrame, log: str, wave_calls: int) -> tuple[DataFrame, int, int]:
    """Calls (``call_key, body``) that no run has an answer to, dealt into waves: table with ``wave``, run, waves.

    Equal requests meet before the shuffle and are one call.
    """
    if wave_calls < 1:
        raise ValueError("a wave has at least one call")
    spark = requests.sparkSession
    runs = _runs(spark, log)
    run = runs[-1] + 1 if runs else 0
    open_ = requests.filter(F.col("body").isNotNull()).groupBy("call_key").agg(F.first("body").alias("body"))
    done = finished_calls(spark, log).filter("call.error IS NULL").select("call_key")
    # The number of waves follows the number of calls; a wave is a hash class of them.
    open_ = open_.join(done, "call_key", "left_anti")
    path = f"{log}/calls/run={run}"
    open_.withColumn("slot", F.pmod(F.xxhash64("call_key"), F.lit(1 << 20)).cast("int")).write.mode("overwrite").parquet(path)
    calls = spark.read.schema("call_key string, body string, slot int").parquet(path)
    waves = math.ceil(calls.count() / wave_calls)
    return calls.withColumn("wave", F.col("slot") % max(1, waves)).drop("slot"), run, waves


def write_wave(outcomes: DataFrame, log: str, run: int, wave: int) -> None:
    """Keep the outcomes of a wave; it counts once its folder is marked complete."""
    outcomes.write.mode("overwrite").parquet(f"{log}/done/run={run}/wave={wave}")
