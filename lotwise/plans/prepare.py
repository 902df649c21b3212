"""Prepare a run: stamped inputs, request files, manifest."""

from __future__ import annotations

import hashlib
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions.adapters import ModelAdapter, adapter_for
from lotwise.functions.naming import (
    brought_back,
    drop_index_column,
    job_name,
    own_column,
    set_aside,
    with_record_id,
)
from lotwise.functions.prompts import PromptTemplate, check_columns, render, required_columns, resolve_prompt
from lotwise.operators.joins import duplicate_ids
from lotwise.operators.numbering import assign_chunks, assign_ordinals
from lotwise.plans.spec import JobSpec
from lotwise.session import WHOLE_BYTES, listings, materialize, scratch_scope
from lotwise.sources.csv_split import read_split_csv
from lotwise.sources.sinks import write_inputs, write_manifest, write_rejected, write_requests
from lotwise.sources.tables import dataset_path, input_format, read_input


#: The column of row numbers that a split CSV is read with.
ROW_NUMBER = "__csv_row"
#: Up to here chunks that lie in several files are told apart from the others.
FEW_CHUNKS = 1000


def source_uri(spec: JobSpec) -> str:
    spec.check_source()
    return spec.input_uri if spec.input_uri is not None else dataset_path(spec.root, spec.dataset_id, spec.split)


def read_source(spark: SparkSession, spec: JobSpec) -> tuple[DataFrame, bool]:
    """The input scan and whether it is a text format (no row positions of its own)."""
    uri = source_uri(spec)
    if spec.dataset_id is not None:
        return spark.read.parquet(uri), False
    if input_format(uri) == "csv" and spec.multi_line == "split":
        return read_split_csv(spark, uri, ordinal=ROW_NUMBER), True
    return read_input(spark, uri, multi_line=spec.multi_line), input_format(uri) == "csv"


def fingerprint(spark: SparkSession, spec: JobSpec) -> str:
    """What tells this run from others under its prefix: ``run_id``, else a hash of source files and spec.

    Paths, lengths and times come from the file listing; no file is read. Where the run
    is stored does not matter.
    """
    if spec.run_id:
        return spec.run_id
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source_uri(spec))
    mark = F.xxhash64("path", "length", F.col("modificationTime").cast("double")).cast("decimal(20,0)")
    found = files.agg(F.count(F.lit(1)), F.sum(mark)).first()
    return hashlib.sha256(f"{found[0]} {found[1]} {replace(spec, root='')}".encode()).hexdigest()[:16]


def stamp(df: DataFrame, spec: JobSpec, text_source: bool = False, run: str | None = None) -> DataFrame:
    """Input rows with ``ordinal``, ``chunk_idx`` and ``record_id``, limits applied.

    Input columns of these names are set aside; see ``brought_back``.
    """
    numbers = df.columns[-1:] == [ROW_NUMBER]  # rows that were numbered when they were read
    renamed = set_aside(df.drop(ROW_NUMBER) if numbers and spec.order_by else df)
    order = [dict(zip(df.columns, renamed.columns)).get(key, key) for key in spec.order_by]
    if numbers and not order:
        numbered = renamed.withColumnRenamed(ROW_NUMBER, "ordinal")
        if spec.row_limit is not None:
            numbered = numbered.filter(F.col("ordinal") < spec.row_limit)
    else:
        numbered = assign_ordinals(
            renamed, order, limit=spec.row_limit, unique=spec.order_is_unique, text_source=text_source
        )
    run = spec.run_id if run is None else run
    stamped = with_record_id(assign_chunks(numbered, spec.chunk_size), spec.job_name_prefix, run)
    return drop_index_column(stamped, text_source)


def request_text(
    inputs: DataFrame, template: PromptTemplate | None, null_policy: str, more: tuple[str, ...] = ()
) -> DataFrame:
    """``chunk_idx, ordinal, record_id`` of saved inputs and ``__text``, null where no request can be written.

    Templates see the input's own columns, also those named like columns of the run. ``more`` columns are kept.
    """
    keys = {"chunk_idx": "__chunk_idx", "ordinal": "__ordinal", "record_id": "__record_id"}
    own = brought_back(inputs.withColumns({new: F.col(old) for old, new in keys.items()}))
    text = render(own, template, null_policy) if template else F.col("input_text").cast("string")
    return own.select(*(F.col(new).alias(old) for old, new in keys.items()), *more, text.alias("__text"))


def build_requests(
    inputs: DataFrame, adapter: ModelAdapter, template: PromptTemplate | None, spec: JobSpec
) -> DataFrame:
    """Request lines (``chunk_idx, ordinal, value``). Rows without text are left out; see ``rejected_inputs``."""
    request = adapter.request(F.col("__text"), F.col("record_id"), **spec.request_options)
    return (
        request_text(inputs, template, spec.null_policy)
        .filter(F.col("__text").isNotNull())
        .select("chunk_idx", "ordinal", F.to_json(request).alias("value"))
    )


def rejected_inputs(
    inputs: DataFrame, template: PromptTemplate | None, null_policy: str = "literal"
) -> DataFrame:
    """Input rows for which no request can be written: null embedding text, or null fields under ``drop``."""
    own = brought_back(inputs)
    text = render(own, template, null_policy) if template else F.col("input_text").cast("string")
    return own.filter(text.isNull())


def chunk_counts(numbered: DataFrame, text: str | None = None, *more: Column) -> DataFrame:
    """Records and requests of each chunk; ``text`` as for ``build_manifest``, ``more`` are further aggregates."""
    return numbered.groupBy("chunk_idx").agg(
        F.count(F.lit(1)).alias("n_records"), F.count(F.col(text) if text else F.lit(1)).alias("n_requests"), *more
    )


def build_manifest(numbered: DataFrame, spec: JobSpec, text: str | None = None) -> DataFrame:
    """One row per job: its name, paths, records and requests.

    ``text`` names the column that is null where a row has no request; without one every
    row has one, and only ``chunk_idx`` is read. A chunk without requests is no job.
    """
    return manifest_of(chunk_counts(numbered, text), spec)


def manifest_of(counts: DataFrame, spec: JobSpec) -> DataFrame:
    """The manifest from records and requests per chunk."""
    at = spec.layout
    folder = F.concat(F.lit("/chunk_idx="), F.col("chunk_idx").cast("string"))

    def path(base: str):
        return F.concat(F.lit(base), folder)

    return counts.filter("n_requests > 0").select(
        "chunk_idx",
        F.lit(spec.model_id).alias("model_id"),
        job_name(spec.job_name_prefix, F.col("chunk_idx"), spec.run_id).alias("job_name"),
        path(at.inputs).alias("inputs_path"),
        path(at.requests).alias("requests_path"),
        path(at.outputs).alias("outputs_path"),
        F.concat(path(at.results), F.lit("/state=ok")).alias("results_path"),
        "n_records",
        "n_requests",
    )


def saved_counts(inputs: DataFrame, template: PromptTemplate | None, null_policy: str) -> DataFrame:
    """``chunk_counts`` of saved inputs, with the files of each chunk and the bytes of its largest one."""
    placed = inputs.select(
        "*", F.col("_metadata.row_index").alias("__row"), F.col("_metadata.file_size").alias("__bytes")
    )
    texts = request_text(placed, template, null_policy, ("__row", "__bytes"))
    first = F.count(F.when(F.col("__row") == 0, True)).alias("n_files")  # every file has one row of number 0
    return chunk_counts(texts, "__text", first, F.max("__bytes").alias("bytes"))


def scattered_chunks(counts: DataFrame) -> tuple[list[int] | None, int]:
    """Chunks that several tasks may read, None if they are many, and the bytes of the largest file of the others.

    Numbered rows lie together, so chunks of several files are those where a task of the writer began.
    """
    apart = (F.col("n_files") > 1) | (F.col("bytes") > WHOLE_BYTES)
    found = counts.agg(F.count_if(apart).alias("n"), F.max(F.when(~apart, F.col("bytes"))).alias("largest")).first()
    if found.n > FEW_CHUNKS:
        return None, 0
    chunks = counts.filter(apart).select("chunk_idx").collect() if found.n else []
    return sorted(r.chunk_idx for r in chunks), found.largest or 0


def prepare(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """Write inputs, requests, rejected inputs and manifest of a run; returns the manifest table.

    Inputs are written first and everything after reads them back, so the
    request files and the saved rows agree by construction. Input rows for which no
    request can be written are saved under ``rejected_inputs``.
    """
    adapter = adapter_for(spec.model_id)
    template = resolve_prompt(adapter.model_type, spec.prompt_id)
    source, text_source = read_source(spark, spec)
    required = required_columns(adapter.model_type, template) | set(spec.order_by)
    check_columns(source, required, f"the input of {spec.job_name_prefix}")

    at = spec.layout
    run = fingerprint(spark, spec)
    with scratch_scope(spark, "prepare"):
        stamped = stamp(source, spec, text_source, run)
        write_inputs(stamped, at.inputs)
    with listings(spark):
        inputs = spark.read.schema(stamped.schema).parquet(at.inputs)
    if spec.unique_ids and own_column(source, "record_id"):
        repeated = duplicate_ids(inputs).limit(5).collect()
        if repeated:
            raise ValueError(f"repeated record ids, such as {[(r.chunk_idx, r.record_id) for r in repeated]}")
    with scratch_scope(spark, "prepare"):
        counts = materialize(saved_counts(inputs, template, spec.null_policy), "chunk-counts")
        write_requests(build_requests(inputs, adapter, template, spec), at.requests, *scattered_chunks(counts))
        write_rejected(rejected_inputs(inputs, template, spec.null_policy), at.rejected_inputs)
        manifest = manifest_of(counts, spec).withColumn("run", F.lit(run))
        write_manifest(manifest, at.manifest)
    return spark.read.schema(manifest.schema).parquet(at.manifest)
