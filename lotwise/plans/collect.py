"""Collect a run: parse output files, join them to the saved inputs, write results."""

from __future__ import annotations

import re
from contextlib import nullcontext
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotwise import fixed
from lotwise.functions.adapters import ModelAdapter, adapter_for
from lotwise.functions.jsonlines import parse_lines
from lotwise.functions.naming import brought_back, job_id
from lotwise.operators.joins import join_results
from lotwise.operators.ledger import collectable_jobs, ledger_states
from lotwise.operators.numbering import SMALL_ROWS
from lotwise.plans.spec import JobSpec
from lotwise.session import by_chunk, changed_at, materialize, scratch_scope, sized_shuffles
from lotwise.sources.outputs import (
    first_files,
    list_outputs,
    locate_bad_lines,
    missing_outputs,
    path_job_id,
    read_outputs,
)
from lotwise.sources.results import read_states, write_results
from lotwise.sources.tables import read_inputs

# Lets the join on (chunk, id) use the partitioning by chunk that the files need anyway.
BY_CHUNK = {"spark__sql__requireAllClusterKeysForCoPartition": "false"}

_MARK = "unusable output line in "


class BadOutputError(ValueError):
    """An output line that cannot be used, with its file and line number where known."""


class MissingOutputError(ValueError):
    """A completed job that left no output file."""


@dataclass(frozen=True)
class Gate:
    """Output files to use; ``files`` is None when all of them are, which are ``listed``."""

    files: DataFrame | None
    listed: DataFrame
    small: bool = True


def extract(lines: DataFrame, adapter: ModelAdapter) -> DataFrame:
    """Parsed output lines: record id, result, and for bad lines ``error`` with the raw line."""
    parsed = parse_lines(lines, adapter.output_schema)
    p = F.col("parsed")
    error = F.coalesce(F.col("error"), adapter.problem(p, F.col("value")))
    good = F.col("error").isNull()
    return parsed.withColumn("error", error).select(
        "chunk_idx",
        "job_id",
        "file_path",
        p["recordId"].alias("record_id"),
        F.when(good, adapter.response(p)).alias(adapter.result_column),
        "error",
        F.when(~good, F.col("value")).alias("line"),
    )


def output_gate(
    spark: SparkSession,
    path: str,
    ledger: DataFrame | None = None,
    accept_partial: bool = False,
    chunks: list[int] | None = None,
    glob: str = fixed.OUTPUT_FILE_GLOB,
    files: DataFrame | None = None,
) -> Gate:
    """First file of each job, of completed jobs only when a ledger is given.

    Built from file names alone, a row per job; broadcast only after counting. ``files`` are the names where they
    are listed already.
    """
    files = list_outputs(spark, path, chunks, glob) if files is None else files
    n = files.agg(F.count(F.lit(1)).alias("files"), F.count_distinct("chunk_idx", "job_id").alias("jobs")).first()
    if ledger is None and n.files == n.jobs:
        return Gate(None, files)
    return Gate(counted_files(files, ledger, accept_partial), files, n.files <= SMALL_ROWS)


def counted_files(files: DataFrame, ledger: DataFrame | None = None, accept_partial: bool = False) -> DataFrame:
    """The first file of each job, of completed jobs only when a ledger is given: ``chunk_idx, file_path, mark``."""
    firsts = first_files(files)
    if ledger is not None:
        firsts = firsts.join(collectable_jobs(ledger, accept_partial).distinct(), "job_id", "left_semi")
    return firsts.select("chunk_idx", "file_path", "mark")


def apply_gate(outputs: DataFrame, gate: Gate) -> DataFrame:
    if gate.files is None:
        return outputs
    if gate.small:
        return outputs.join(F.broadcast(gate.files.drop("mark")), ["chunk_idx", "file_path"], "left_semi")
    # Files are unique, so an inner join keeps the same rows; a semi join would be
    # moved below the repartitioning by chunk and shuffle the lines once more.
    return outputs.join(gate.files.drop("mark"), ["chunk_idx", "file_path"])


def fail_on_bad(outputs: DataFrame) -> DataFrame:
    """Stop the query at the first bad line."""
    message = F.concat(F.lit(_MARK), F.col("file_path"), F.lit(" : "), F.col("error"), F.lit(" : "), F.col("line"))
    checked = F.when(F.col("error").isNotNull(), F.raise_error(message).cast("string")).otherwise(F.col("record_id"))
    return outputs.withColumn("record_id", checked)


def _check_mode(on_bad: str) -> None:
    if on_bad not in ("quarantine", "fail"):
        raise ValueError("on_bad must be quarantine or fail")


def _outputs(
    spark: SparkSession,
    spec: JobSpec,
    ledger: DataFrame | None,
    accept_partial: bool,
    chunks: list[int] | None,
    files: DataFrame | None = None,
) -> tuple[DataFrame, Gate, ModelAdapter]:
    adapter = adapter_for(spec.model_id)
    path, glob = spec.layout.outputs, spec.output_glob
    gate = output_gate(spark, path, ledger, accept_partial, chunks, glob, files)
    return extract(read_outputs(spark, path, chunks, glob), adapter), gate, adapter


def collect(
    spark: SparkSession,
    spec: JobSpec,
    ledger: DataFrame | None = None,
    accept_partial: bool = False,
    chunks: list[int] | None = None,
    on_bad: str = "quarantine",
) -> DataFrame:
    """Good answers joined to their inputs, as a DataFrame.

    Bad lines are left out. With ``fail`` they are looked for first, and the call stops
    with file and line number of one.
    """
    _check_mode(on_bad)
    outputs, gate, adapter = _outputs(spark, spec, ledger, accept_partial, chunks)
    outputs = apply_gate(outputs, gate)
    if on_bad == "fail":
        bad = outputs.filter(F.col("error").isNotNull()).select("file_path", "error", "line").first()
        if bad is not None:
            raise _named(spark, unquote(bad.file_path), bad.error, bad.line, adapter.output_schema)
    outputs = outputs.filter(F.col("error").isNull())
    inputs = read_inputs(spark, spec.layout.inputs, chunks)
    joined = join_results(outputs.drop("error", "line", "file_path", "job_id"), inputs, adapter.result_column)
    return brought_back(joined)


def missing_jobs(
    spark: SparkSession,
    spec: JobSpec,
    ledger: DataFrame,
    accept_partial: bool = False,
    chunks: list[int] | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """Jobs to be collected that left no output file: ``job_id, chunk_idx`` (null where the ledger has none)."""
    chunk = F.col("chunk_idx").cast("int") if "chunk_idx" in ledger.columns else F.lit(None).cast("int")
    jobs = ledger.select(job_id(F.col("job_arn")).alias("job_id"), chunk.alias("chunk_idx"))
    jobs = jobs.join(collectable_jobs(ledger, accept_partial).distinct(), "job_id", "left_semi")
    if chunks is not None:
        jobs = jobs.filter(F.col("chunk_idx").isin(chunks))
    files = list_outputs(spark, spec.layout.outputs, chunks, spec.output_glob) if files is None else files
    return missing_outputs(jobs, files)


def joined_states(outputs: DataFrame, inputs: DataFrame, result: str) -> DataFrame:
    """All output lines with their input row and a ``state``: ``ok``, ``rejected`` (bad line) or ``unmatched``."""
    origin = F.struct("job_id", "file_path", "error", F.col("line").alias("text")).alias("output_line")
    packed = outputs.select("chunk_idx", "record_id", result, origin)
    joined = join_results(packed, inputs.withColumn("__known", F.lit(True)), result, "left")
    state = (
        F.when(F.col("output_line.error").isNotNull(), "rejected")
        .when(F.col("__known").isNull(), "unmatched")
        .otherwise("ok")
    )
    return joined.withColumn("state", state).drop("__known")


def run_collect(
    spark: SparkSession,
    spec: JobSpec,
    ledger: DataFrame | None = None,
    accept_partial: bool = False,
    chunks: list[int] | None = None,
    on_bad: str = "quarantine",
    on_missing: str = "fail",
    keep_replaced: bool = False,
) -> DataFrame:
    """Write ``results/chunk_idx=N/state=...`` in one pass over the outputs and return the written table.

    With a ledger, a completed job without an output file stops the run, or becomes a
    row of state ``missing`` (``on_missing="report"``). Given ``chunks`` are replaced whole, in one step:
    until then, and if the run fails, readers see the rows of before (``keep_replaced``: see ``write_results``).
    Several steps ask for the ledger and, with one, for the names of the files: both are read once, into scratch tables.

    Both sides are shuffled once, by chunk: that serves the file gate, the join on
    (chunk, id) and the one-file-per-chunk layout together. Chunks have equal,
    bounded sizes, so the tasks are even whatever the ids look like.
    """
    _check_mode(on_bad)
    if on_missing not in ("fail", "report"):
        raise ValueError("on_missing must be fail or report")
    with scratch_scope(spark, "collect") if ledger is not None else nullcontext():
        schema = _write_states(spark, spec, ledger, accept_partial, chunks, on_bad, on_missing, keep_replaced)
    return read_states(spark, spec.layout.results, schema)


def _write_states(
    spark: SparkSession,
    spec: JobSpec,
    ledger: DataFrame | None,
    accept_partial: bool,
    chunks: list[int] | None,
    on_bad: str,
    on_missing: str,
    keep_replaced: bool,
) -> StructType:
    """The write of ``run_collect``; returns the schema of the written rows."""
    missing = None
    files = list_outputs(spark, spec.layout.outputs, chunks, spec.output_glob)
    if ledger is not None:
        files = materialize(files.repartition("chunk_idx"), "output-files")
        ledger = materialize(ledger_states(ledger), "ledger")
        missing = missing_jobs(spark, spec, ledger, accept_partial, chunks, files)
        first = missing.limit(5).collect() if on_missing == "fail" else []
        if first:
            raise MissingOutputError(f"completed jobs without an output file, such as {[r.job_id for r in first]}")
    lines, gate, adapter = _outputs(spark, spec, ledger, accept_partial, chunks, files)
    inputs = read_inputs(spark, spec.layout.inputs, chunks)
    # A small gate drops files before the shuffle, a large one rides on it.
    if gate.small:
        outputs = by_chunk(apply_gate(lines, gate), lines, inputs)
    else:
        outputs = apply_gate(by_chunk(lines, lines, inputs), gate)
    if on_bad == "fail":
        outputs = fail_on_bad(outputs)
    states = joined_states(outputs, by_chunk(inputs, lines, inputs), adapter.result_column)
    if missing is not None and on_missing == "report":
        states = states.unionByName(_missing_rows(missing, states), allowMissingColumns=True)
    with sized_shuffles(spark, lines, inputs, **BY_CHUNK):
        try:
            write_results(states, spec.layout.results, chunks, gate_jobs(gate, spec.layout.inputs), keep_replaced)
        except Exception as exc:
            raise _located(spark, exc, adapter.output_schema) from exc
    return states.schema


def gate_jobs(gate: Gate, inputs: str) -> DataFrame:
    """Jobs whose files are used: ``chunk_idx, job_id`` and ``mark`` of file and inputs, from file names alone."""
    files = with_inputs(gate.listed if gate.files is None else gate.files, inputs)
    return files.select("chunk_idx", path_job_id(F.col("file_path")).alias("job_id"), "mark").distinct()


def with_inputs(files: DataFrame, inputs: str) -> DataFrame:
    """Marks of files that also tell when the inputs were saved: results of other inputs are out of date."""
    saved = changed_at(files.sparkSession, f"{inputs}/_SUCCESS")
    return files.withColumn("mark", F.xxhash64("mark", F.lit(saved)))


def _missing_rows(missing: DataFrame, states: DataFrame) -> DataFrame:
    line = {f.name: F.lit(None).cast(f.dataType) for f in states.schema["output_line"].dataType.fields}
    line |= {"job_id": F.col("job_id"), "error": F.lit("no output file")}
    return missing.select(
        "chunk_idx",
        F.lit("missing").alias("state"),
        F.struct(*(c.alias(n) for n, c in line.items())).alias("output_line"),
    )


def _located(spark: SparkSession, exc: Exception, schema: str) -> Exception:
    """The failure with the line number, found by reading the one offending file again."""
    found = re.search(re.escape(_MARK) + r"(\S+) : ([^\n]*?) : (.*)", str(exc))
    if not found:
        return exc
    path, why, line = found.groups()
    return _named(spark, unquote(path), why, line, schema)  # the path is reported URL-encoded


def _named(spark: SparkSession, path: str, why: str, line: str | None, schema: str) -> BadOutputError:
    """The failure of a known file, with the line number if a line of it does not parse."""
    bad = locate_bad_lines(spark, [path], schema).orderBy("line_number").first()
    if bad is not None:
        return BadOutputError(f"cannot parse {path} on line {bad.line_number}: {bad.value!r}")
    return BadOutputError(f"{path}: {why}: {line}")


def good_results(table: DataFrame) -> DataFrame:
    """Result rows of a run: input columns plus the answer."""
    return brought_back(table.filter(F.col("state") == "ok").drop("state", "output_line"))


def rejected_lines(table: DataFrame) -> DataFrame:
    """Output lines that gave no result: where they are, why, and the line itself."""
    return table.filter(F.col("state") != "ok").select("state", "chunk_idx", "record_id", "output_line.*")
