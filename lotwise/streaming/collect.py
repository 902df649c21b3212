"""Collecting finished chunks as their output files arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotwise import fixed
from lotwise.functions.adapters import ModelAdapter
from lotwise.functions.naming import job_id
from lotwise.operators.ledger import collectable_jobs, ledger_states
from lotwise.plans.collect import (
    BY_CHUNK,
    apply_gate,
    counted_files,
    extract,
    gate_jobs,
    joined_states,
    output_gate,
    with_inputs,
)
from lotwise.session import by_chunk, changed_at, children, listings, materialize, scratch_scope, sized_shuffles
from lotwise.sources.outputs import file_mark, list_outputs, path_chunk_idx, path_job_id, read_outputs
from lotwise.sources.results import built_jobs, files_mark, named_chunks, write_results
from lotwise.sources.tables import read_inputs


#: Chunks that are built together where many wait, whatever the batches of the stream hold.
CHUNKS_AT_ONCE = 5000
#: Files of the backlog that the driver remembers by their marks; chunks of others are looked at once more.
REMEMBERED_FILES = 500_000


def read_output_stream(
    spark: SparkSession, path: str, files_per_batch: int = 1000, glob: str = fixed.OUTPUT_FILE_GLOB
) -> DataFrame:
    """Lines of output files as they arrive, with chunk, job and file."""
    reader = (
        spark.readStream.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
    )
    with listings(spark):
        scan = reader.text(path, lineSep="\n")
    file_path = F.col("_metadata.file_path")
    return scan.select(
        "value",
        path_chunk_idx(file_path).alias("chunk_idx"),
        file_path.alias("file_path"),
        path_job_id(file_path).alias("job_id"),
    )


def watch_outputs(
    spark: SparkSession, path: str, files_per_batch: int = 1000, glob: str = fixed.OUTPUT_FILE_GLOB
) -> DataFrame:
    """Names of output files as they arrive, with their chunk and the ``mark`` of ``list_outputs``; contents are not read."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
    )
    with listings(spark):
        scan = reader.load(path)
    file_path = F.col("_metadata.file_path")
    return scan.select(
        file_path.alias("file_path"), path_chunk_idx(file_path).alias("chunk_idx"), file_mark().alias("mark")
    )


def due_jobs(spark: SparkSession, results: str, ledger: DataFrame, accept_partial: bool = False) -> DataFrame:
    """Jobs to be collected that are not in the results: ``chunk_idx`` (null where the ledger has none), ``job_id``.

    Reads the ledger and the commits of the results, a row per chunk, and neither results nor outputs.
    """
    chunk = F.col("chunk_idx").cast("int") if "chunk_idx" in ledger.columns else F.lit(None).cast("int")
    jobs = ledger.select(chunk.alias("chunk_idx"), job_id(F.col("job_arn")).alias("job_id")).distinct()
    jobs = jobs.join(collectable_jobs(ledger, accept_partial).distinct(), "job_id", "left_semi")
    built = built_jobs(spark, results)
    known = jobs.filter("chunk_idx IS NOT NULL").join(built, ["chunk_idx", "job_id"], "left_anti")
    unknown = jobs.filter("chunk_idx IS NULL").join(built.select("job_id"), "job_id", "left_anti")
    return known.unionByName(unknown)


def due_chunks(
    spark: SparkSession,
    outputs: str,
    results: str,
    ledger: DataFrame,
    accept_partial: bool = False,
    glob: str = fixed.OUTPUT_FILE_GLOB,
) -> list[int]:
    """Chunks with a completed job whose file is there but not in the results: only their folders are listed.

    A ledger that does not name a job's chunk makes it look through all of them.
    """
    waiting = due_jobs(spark, results, ledger, accept_partial).persist()
    try:
        chunks = [r.chunk_idx for r in waiting.select("chunk_idx").distinct().collect()]
        if not chunks:
            return []
        files = list_outputs(spark, outputs, None if None in chunks else sorted(chunks), glob)
        found = files.select("chunk_idx", "job_id").distinct()
        there = found.join(waiting.select("job_id").distinct(), "job_id", "left_semi")
        there = there.join(built_jobs(spark, results), ["chunk_idx", "job_id"], "left_anti")
        return sorted(r.chunk_idx for r in there.select("chunk_idx").distinct().collect())
    finally:
        waiting.unpersist()


def outdated_chunks(
    spark: SparkSession, results: str, counted: DataFrame, chunks: list[int] | None = None
) -> list[int]:
    """Chunks whose results were not built of the files that count now, of the given ones or of all that have files.

    Reads file names and the commits of the results, a row per chunk.
    """
    now = counted.groupBy("chunk_idx").agg(files_mark().alias("now"))
    if chunks is not None:
        now = spark.createDataFrame([(c,) for c in chunks], "chunk_idx int").join(now, "chunk_idx", "left")
    built = named_chunks(spark, results).select("chunk_idx", "files")
    changed = now.join(built, "chunk_idx", "left").filter(~F.col("now").eqNullSafe(F.col("files")))
    return sorted(r.chunk_idx for r in changed.select("chunk_idx").collect())


def stream_collect(
    spark: SparkSession,
    outputs: str,
    inputs: str,
    results: str,
    checkpoint: str,
    adapter: ModelAdapter,
    files_per_batch: int = 1000,
    available_now: bool = True,
    glob: str = fixed.OUTPUT_FILE_GLOB,
    ledger: Callable[[SparkSession], DataFrame] | None = None,
    accept_partial: bool = False,
    keep_replaced: bool = False,
) -> StreamingQuery:
    """Rebuild the results of each chunk that gets a new output file.

    The stream carries file names only. A touched chunk is built again from all its files
    that count, as the batch collect would build it, and replaced in one step, so a replayed
    batch and any order of arrival leave the same results. ``ledger`` reads the ledger and
    is called for every batch: then only files of completed jobs count. A job may complete
    after its files arrived: chunks whose jobs are due but not in the results are rebuilt
    when the stream starts, and by later batches. What is built stands in the commits of the
    results, so a batch reads the files of its own chunks and no finished ones, and a chunk
    that was built of the files and inputs that count now is left as it is.

    Without a ledger too, chunks that wait when the stream starts are built at once, ``CHUNKS_AT_ONCE`` together:
    a backlog takes as many rebuilds as its chunks need, however few files a batch has. Its files then come in batches
    like all others; one that is still the file that was looked at, of inputs that are still the same, needs no second
    look, so such a batch reads the names of its files and nothing else. A file of the backlog that is deleted meanwhile
    is noticed when its chunk is looked at next, at the latest when a stream starts.
    """
    at_once = max(files_per_batch, CHUNKS_AT_ONCE)
    looked_at: set[int] = set()  # marks of files of the backlog that have not come in a batch
    saved_at = 0

    def rebuild(session: SparkSession, known: DataFrame | None, chunks: list[int]) -> None:
        for at in range(0, len(chunks), at_once):
            some = chunks[at : at + at_once]
            gate = output_gate(session, outputs, known, accept_partial, some, glob)
            read = extract(read_outputs(session, outputs, some, glob), adapter)
            saved = read_inputs(session, inputs, some)
            lines = by_chunk(apply_gate(read, gate), saved, most=len(some))
            states = joined_states(lines, by_chunk(saved, saved, most=len(some)), adapter.result_column)
            with sized_shuffles(session, saved, **BY_CHUNK):
                write_results(states, results, some, gate_jobs(gate, inputs), keep_replaced)

    def due(session: SparkSession, known: DataFrame) -> list[int]:
        return due_chunks(session, outputs, results, known, accept_partial, glob)

    def catch_up(session: SparkSession, touched: list[int] | None) -> None:
        """Build chunks that wait: the touched ones, or all of them, and with a ledger those whose jobs are due."""
        known = None if ledger is None else ledger(session)
        chunks: set[int] = set()
        if touched or known is None:
            listed = list_outputs(session, outputs, touched, glob)
            files = counted_files(listed, known, accept_partial)
            chunks |= set(outdated_chunks(session, results, with_inputs(files, inputs), touched))
            if touched is None:
                looked_at.update(r.mark for r in listed.select("mark").limit(REMEMBERED_FILES).collect())
        if known is not None:
            chunks |= set(due(session, known))
        if known is None or not chunks:
            rebuild(session, known, sorted(chunks))
        else:  # every rebuild asks for the ledger several times
            with scratch_scope(session, "stream-collect"):
                rebuild(session, materialize(ledger_states(known), "ledger"), sorted(chunks))

    def write_batch(batch: DataFrame, _: int) -> None:
        if looked_at and changed_at(batch.sparkSession, f"{inputs}/_SUCCESS") != saved_at:
            looked_at.clear()
        files = batch.collect()  # a row per file; as it is, since one more plan takes longer than a few names
        touched = sorted({r.chunk_idx for r in files if r.mark not in looked_at})
        looked_at.difference_update(r.mark for r in files)
        if touched or ledger is not None:
            catch_up(batch.sparkSession, touched)

    if children(spark, outputs):
        saved_at = changed_at(spark, f"{inputs}/_SUCCESS")
        catch_up(spark, None)
    writer = (
        watch_outputs(spark, outputs, files_per_batch, glob)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
