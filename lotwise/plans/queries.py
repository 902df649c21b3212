"""The registered queries, each next to the SQL that gives the same rows.

All read the whole given tables. Service output is derived from them by Spark:
answers exist for labelled documents, so the unlabelled ones are the missing ones.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotwise import fixed
from lotwise.functions.adapters import adapter_for, route_requests
from lotwise.functions.jsonlines import parse_lines, split_good_bad, strict_json
from lotwise.functions.naming import drop_index_column, job_id, job_name, with_record_id
from lotwise.functions.prompts import render, render_by_id, resolve_prompt, unknown_prompt_ids
from lotwise.operators.calls import Throttled
from lotwise.operators.joins import duplicate_ids, join_results, unmatched
from lotwise.operators.ledger import (
    classify,
    collectable_jobs,
    failure_message,
    failure_windows,
    join_ledger,
    latest_status,
    ledger_rows,
    unknown_states,
    update_ledger,
)
from lotwise.operators.numbering import (
    assign_chunks,
    number_by_file,
    number_by_key,
    number_by_split,
    number_lines,
    running_total,
)
from lotwise.operators.reports import (
    estimate_cost,
    input_preview,
    limit_head,
    output_paths,
    records_per_chunk,
    response_preview,
    sample_success,
    score_summary,
)
from lotwise.operators.scoring import input_text_fallback, score_embeddings, score_text, score_to
from lotwise.plans.collect import collect, extract, good_results, rejected_lines, run_collect
from lotwise.plans.prepare import build_manifest, build_requests, prepare, rejected_inputs, stamp
from lotwise.plans.spec import JobSpec
from lotwise.session import by_chunk, listings, materialize, planned_bytes, scratch_path, settings
from lotwise.sources.calls import call_keys, finished_calls
from lotwise.sources.outputs import first_files, missing_outputs, path_chunk_idx
from lotwise.sources.results import read_results, read_states
from lotwise.sources.sinks import write_csv, write_requests
from lotwise.sources.tables import read_dataset, read_input, read_inputs, stage_dataset
from lotwise.streaming.collect import stream_collect
from lotwise.streaming.status import fold_events, read_log, route_events
from lotwise.streaming.timers import alarm_transitions, expired_jobs, write_timed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TEXT_MODEL = f"{fixed.TEXT_MODEL_MARK}.sample-v1"
EMBEDDING_MODEL = fixed.EMBEDDING_MODEL_MARK
SIZE = 100
#: Bytes of a table, by Spark's statistics, that go into one CSV file.
CSV_FILE_BYTES = 256 << 20


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_input(spark, f"{d}/{name}.parquet")


def spec_for(d: str, root: str = ".", **changes) -> JobSpec:
    """Job over all documents in doc_id order."""
    job = {
        "job_name_prefix": "docs",
        "model_id": TEXT_MODEL,
        "root": root,
        "input_uri": f"{d}/documents.parquet",
        "prompt_id": "tone_of_text",
        "max_records_per_job": SIZE,
        "order_by": ["doc_id"],
        "order_is_unique": True,
        "output_glob": "part-*",
    }
    return JobSpec(**{**job, **changes})


def stamped(spark: SparkSession, d: str, **changes) -> DataFrame:
    spec = spec_for(d, **changes)
    return stamp(table(spark, d, "documents"), spec)


ORDINALS = "SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM documents"
STAMPED = (
    f"SELECT *, CAST(ordinal // {SIZE} AS INTEGER) AS chunk_idx, sha256('docs:' || ordinal)[1:32] AS record_id "
    f"FROM ({ORDINALS})"
)
#: Saved runs name themselves in their ids.
RUN = {"run_id": "r1"}
RUN_STAMPED = STAMPED.replace("'docs:'", "'docs:r1:'")
PROMPT = "'Is the mood of this text positive, negative or neutral?' || chr(10) || chr(10) || text"


# --- numbering, chunks, limits -------------------------------------------------------------


@query(f"SELECT doc_id, ordinal, chunk_idx, record_id FROM ({STAMPED})")
def chunk_assign(spark, d):
    return stamped(spark, d).select("doc_id", "ordinal", "chunk_idx", "record_id")


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS ordinal, "
    "CAST((row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // 1000 AS INTEGER) "
    "AS chunk_idx FROM lineitem"
)
def chunk_assign_large(spark, d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, d, "lineitem").select(*keys)
    return assign_chunks(number_by_key(lines, keys), 1000).select(*keys, "ordinal", "chunk_idx")


@query(
    "SELECT event_id, ts, row_number() OVER (ORDER BY event_id) - 1 AS ordinal, "
    "CAST((row_number() OVER (ORDER BY event_id) - 1) // 1000 AS INTEGER) AS chunk_idx FROM events"
)
def chunk_assign_file_order(spark, d):
    numbered = number_by_file(table(spark, d, "events"))
    return assign_chunks(numbered, 1000).select("event_id", "ts", "ordinal", "chunk_idx")


@query(
    "SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS ordinal FROM conversations"
)
def chunk_assign_csv_order(spark, d):
    path = scratch_path(spark, "conversations") + ".csv"
    write_csv(table(spark, d, "conversations").repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn"), path)
    numbered = number_by_split(read_input(spark, path))
    return numbered.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "ordinal")


@query(
    "SELECT l_returnflag, count(*) AS n_rows, min(ordinal) AS first_ordinal, max(ordinal) AS last_ordinal FROM "
    "(SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) - 1 AS ordinal FROM lineitem) GROUP BY 1"
)
def chunk_assign_hot_keys(spark, d):
    """Three key values share all rows: ties must spread over tasks and still be numbered densely."""
    numbered = number_by_key(table(spark, d, "lineitem"), ["l_returnflag"])
    return numbered.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("ordinal").alias("first_ordinal"),
        F.max("ordinal").alias("last_ordinal"),
    )


@query(f"SELECT doc_id, ordinal, chunk_idx FROM ({STAMPED}) WHERE ordinal < 150")
def limit_records(spark, d):
    return stamped(spark, d, max_records_total=150).select("doc_id", "ordinal", "chunk_idx")


@query(f"SELECT doc_id, ordinal, chunk_idx FROM ({STAMPED}) WHERE chunk_idx < 2")
def limit_jobs(spark, d):
    return stamped(spark, d, max_num_jobs=2).select("doc_id", "ordinal", "chunk_idx")


@query("SELECT event_id, event_id AS ordinal FROM events ORDER BY event_id LIMIT 2500")
def limit_file_order(spark, d):
    return number_by_file(table(spark, d, "events"), limit=2500).select("event_id", "ordinal")


@query(
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 15000"
)
def limit_head_large(spark, d):
    """More rows than one task should sort: taken by their number in key order."""
    return limit_head(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], 15_000).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query("SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 10")
def limit_head_rows(spark, d):
    return limit_head(table(spark, d, "documents"), ["doc_id"], fixed.INLINE_MAX_RECORDS).select(
        "doc_id", "lang", "source"
    )


@query(
    "SELECT chunk_idx, n_records, CAST(coalesce(sum(n_records) OVER (ORDER BY chunk_idx ROWS BETWEEN UNBOUNDED "
    f"PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rows_before FROM (SELECT chunk_idx, count(*) AS n_records FROM ({STAMPED}) GROUP BY 1)"
)
def manifest_running_total(spark, d):
    return running_total(records_per_chunk(stamped(spark, d)))


# --- prompts and requests ------------------------------------------------------------------


@query("SELECT doc_id, 'Classify ' || lang || ' from {' || source || '}: ' || text AS prompt FROM documents")
def render_prompt(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", render(docs, "Classify {lang} from {{{source}}}: {text}").alias("prompt"))


@query("SELECT conv_id, turn, 'Turn ' || turn || ' (' || role || '): ' || text AS prompt FROM conversations")
def render_conversations(spark, d):
    turns = table(spark, d, "conversations")
    return turns.select("conv_id", "turn", render(turns, "Turn {turn} ({role!s}): {text}").alias("prompt"))


@query(
    "SELECT doc_id, 'Language: ' || coalesce(nullif(lang, 'en'), 'None') AS literal_prompt, "
    "'Language: ' || coalesce(nullif(lang, 'en'), '') AS empty_prompt, "
    "'Language: ' || nullif(lang, 'en') AS dropped_prompt FROM documents"
)
def render_nulls(spark, d):
    docs = table(spark, d, "documents").withColumn("lang", F.nullif("lang", F.lit("en")))
    return docs.select(
        "doc_id",
        render(docs, "Language: {lang}", "literal").alias("literal_prompt"),
        render(docs, "Language: {lang}", "empty").alias("empty_prompt"),
        render(docs, "Language: {lang}", "drop").alias("dropped_prompt"),
    )


@query("SELECT doc_id, 'Start: ' || text[1:100] || ' <' || lang || '>' AS prompt FROM documents")
def render_spec(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", render(docs, "Start: {text:.100} <{lang!s}>").alias("prompt"))


@query(
    "SELECT event_id, event_type || ' by ' || printf('%06d', user_id) || ': ' || printf('%10.2f', value) || "
    "' ' || printf('%-9s', event_type) || '|' AS prompt FROM events"
)
def render_python_spec(spark, d):
    events = table(spark, d, "events")
    return events.select(
        "event_id", render(events, "{event_type} by {user_id:06d}: {value:10.2f} {event_type:<9}|").alias("prompt")
    )


@query(
    f"SELECT chunk_idx, ordinal, CAST(to_json({{'recordId': record_id, 'modelInput': {{'anthropic_version': "
    f"'{fixed.TEXT_API_VERSION}', 'max_tokens': {fixed.BATCH_MAX_TOKENS}, 'messages': [{{'role': 'user', 'content': "
    f"[{{'type': 'text', 'text': {PROMPT}}}]}}]}}}}) AS VARCHAR) AS value FROM ({STAMPED})"
)
def text_request(spark, d):
    spec = spec_for(d)
    adapter = adapter_for(spec.model_id)
    return build_requests(stamped(spark, d), adapter, resolve_prompt("text", spec.prompt_id), spec)


@query(
    "SELECT chunk_idx, ordinal, CAST(to_json({'recordId': record_id, 'modelInput': {'inputText': text, "
    f"'dimensions': 256, 'normalize': true}}}}) AS VARCHAR) AS value FROM ({STAMPED})"
)
def embed_request(spark, d):
    spec = spec_for(
        d, model_id=EMBEDDING_MODEL, prompt_id=None, request_options={"dimensions": 256, "normalize": True}
    )
    rows = stamped(spark, d).withColumnRenamed("text", "input_text")
    return build_requests(rows, adapter_for(spec.model_id), None, spec)


@query("SELECT doc_id FROM documents WHERE lang = 'de'")
def rejected_null_inputs(spark, d):
    """Embedding rows without text get no request."""
    rows = table(spark, d, "documents").select("doc_id", F.when(F.col("lang") != "de", F.col("text")).alias("input_text"))
    return rejected_inputs(rows, None).select("doc_id")


MIXED = {"classify_en": "Classify: {text}", "translate_fr": "Translate from {lang}: {text}"}


@query(
    "SELECT doc_id, CASE lang WHEN 'en' THEN 'Classify: ' || text WHEN 'fr' THEN 'Translate from fr: ' || text END "
    "AS prompt FROM documents"
)
def mixed_prompts(spark, d):
    docs = _with_prompt_id(spark, d)
    return docs.select("doc_id", render_by_id(docs, "prompt_id", MIXED).alias("prompt"))


@query(
    "SELECT 'other_' || lang AS prompt_id, count(*) AS n_rows FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY 1"
)
def unknown_prompts(spark, d):
    return unknown_prompt_ids(_with_prompt_id(spark, d), "prompt_id", MIXED)


def _with_prompt_id(spark: SparkSession, d: str) -> DataFrame:
    lang = F.col("lang")
    prompt_id = (
        F.when(lang == "en", "classify_en").when(lang == "fr", "translate_fr").otherwise(F.concat(F.lit("other_"), lang))
    )
    return table(spark, d, "documents").withColumn("prompt_id", prompt_id)


@query(
    "SELECT doc_id, CASE lang WHEN 'en' THEN CAST(to_json({'recordId': CAST(doc_id AS VARCHAR), 'modelInput': "
    f"{{'anthropic_version': '{fixed.TEXT_API_VERSION}', 'max_tokens': 5, 'messages': "
    "[{'role': 'user', 'content': [{'type': 'text', 'text': text}]}]}}) AS VARCHAR) "
    "WHEN 'fr' THEN CAST(to_json({'recordId': CAST(doc_id AS VARCHAR), 'modelInput': {'inputText': text, "
    "'dimensions': 256}}) AS VARCHAR) "
    "END AS value FROM documents"
)
def mixed_models(spark, d):
    lang = F.col("lang")
    model = F.when(lang == "en", TEXT_MODEL).when(lang == "fr", EMBEDDING_MODEL).otherwise("some.other-model")
    options = {"text": {"max_tokens": 5}, "embedding": {"dimensions": 256}}
    return table(spark, d, "documents").select(
        "doc_id", route_requests(model, F.col("text"), F.col("doc_id").cast("string"), options).alias("value")
    )


@query(
    "SELECT doc_id, CASE WHEN lang <> 'de' THEN lang WHEN source <> 'src0' THEN source ELSE CAST(doc_id AS VARCHAR) END "
    "AS input_text FROM documents"
)
def embedding_text_fallback(spark, d):
    rows = table(spark, d, "documents").select(
        "doc_id",
        F.when(F.col("lang") != "de", F.col("lang")).alias("text"),
        F.when(F.col("source") != "src0", F.col("source")).otherwise("").alias("source"),
        F.col("doc_id").alias("topic"),
    )
    return input_text_fallback(rows).select("doc_id", "input_text")


@query(
    "SELECT doc_id, sha256('docs:' || (row_number() OVER (ORDER BY doc_id) - 1))[1:32] AS generated, "
    "CASE WHEN lang = 'en' THEN sha256('docs:' || (row_number() OVER (ORDER BY doc_id) - 1))[1:32] "
    "ELSE CAST(doc_id AS VARCHAR) END AS kept FROM documents"
)
def record_ids(spark, d):
    numbered = number_by_key(table(spark, d, "documents").select("doc_id", "lang"), ["doc_id"], unique=True)
    made = with_record_id(numbered, "docs").withColumnRenamed("record_id", "generated")
    own = made.withColumn("record_id", F.when(F.col("lang") != "en", F.col("doc_id")))
    return with_record_id(own, "docs").select("doc_id", "generated", F.col("record_id").alias("kept"))


@query(
    "SELECT chunk_idx, 'run-' || chunk_idx AS submission, regexp_replace('A long run name with spaces and_marks "
    "0123456789'[1:46] || '-part-' || printf('%04d', chunk_idx) || '-' || sha256('A long run name with spaces and_marks 0123456789:' || "
    f"chunk_idx)[1:6], '[^a-zA-Z0-9-]', '', 'g') AS job_name FROM (SELECT DISTINCT chunk_idx FROM ({STAMPED}))"
)
def job_names(spark, d):
    chunks = records_per_chunk(stamped(spark, d))
    name = job_name("A long run name with spaces and_marks 0123456789", F.col("chunk_idx"))
    return chunks.select(
        "chunk_idx", F.concat(F.lit("run-"), F.col("chunk_idx")).alias("submission"), name.alias("job_name")
    )


@query(
    "SELECT chunk_idx, n_records, "
    f"'{TEXT_MODEL}' AS model_id, 'docs-part-' || printf('%04d', chunk_idx) || '-' || sha256('docs:' || chunk_idx)[1:6] "
    "AS job_name, '/data/docs/inputs/chunk_idx=' || chunk_idx AS inputs_path, "
    "'/data/docs/requests/chunk_idx=' || chunk_idx AS requests_path, "
    "'/data/docs/outputs/chunk_idx=' || chunk_idx AS outputs_path, "
    "'/data/docs/results/chunk_idx=' || chunk_idx || '/state=ok' AS results_path, n_records AS n_requests "
    f"FROM (SELECT chunk_idx, count(*) AS n_records FROM ({STAMPED}) GROUP BY 1)"
)
def manifest(spark, d):
    return build_manifest(stamped(spark, d), spec_for(d, root="/data"))


@query(
    "SELECT chunk_idx, '/data/docs/results/chunk_idx=' || chunk_idx || '/state=ok' AS results_path "
    f"FROM (SELECT DISTINCT chunk_idx FROM ({STAMPED}))"
)
def result_paths(spark, d):
    return output_paths(build_manifest(stamped(spark, d), spec_for(d, root="/data")))


# --- sources and sinks ---------------------------------------------------------------------


@query(f"SELECT chunk_idx, record_id, {PROMPT} AS prompt FROM ({RUN_STAMPED})")
def request_jsonl_roundtrip(spark, d):
    spec = spec_for(d, root=scratch_path(spark, "requests"), **RUN)
    prepare(spark, spec)
    with listings(spark):
        lines = spark.read.text(spec.layout.requests)
    schema = (
        "recordId string, modelInput struct<messages: array<struct<content: array<struct<text: string>>>>>"
    )
    body = F.col("parsed.modelInput.messages")[0]["content"][0]["text"]
    return parse_lines(lines, schema).select("chunk_idx", F.col("parsed.recordId").alias("record_id"), body.alias("prompt"))


@query("SELECT conv_id, turn, role, text FROM conversations")
def read_csv_roundtrip(spark, d):
    path = scratch_path(spark, "table") + ".csv"
    write_csv(table(spark, d, "conversations"), path)
    rows = read_input(spark, path)
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")


@query("SELECT doc_id, text, lang, n_chars FROM documents")
def csv_split_scan(spark, d):
    """CSV files whose texts hold line breaks, quotes and commas, each read in many splits.

    One task writes a file, so a file holds ``CSV_FILE_BYTES`` of the table at most: a small table makes one file.
    """
    path = scratch_path(spark, "split") + ".csv"
    rows = table(spark, d, "documents").select("doc_id", "text", "lang", "n_chars")
    write_csv(rows.repartition(1 + planned_bytes(rows) // CSV_FILE_BYTES), path)
    files = spark.read.format("binaryFile").load(path)
    size = files.agg(F.max("length")).first()[0] or 0
    with settings(spark, spark__sql__files__maxPartitionBytes=str(max(1, size // 16)), spark__sql__files__openCostInBytes="0"):
        found = read_input(spark, path, multi_line="split")
    return found.select(F.col("doc_id").cast("long"), "text", "lang", F.col("n_chars").cast("long"))


@query("SELECT doc_id, lang, n_chars FROM documents")
def csv_index_column(spark, d):
    """A CSV whose first header is blank, as saved with an index, loses that column."""
    path = scratch_path(spark, "indexed") + ".csv"
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("Unnamed: 0"), "doc_id", "lang", "n_chars")
    write_csv(rows, path)
    kept = drop_index_column(read_input(spark, path))
    return kept.select(F.col("doc_id").cast("long"), "lang", F.col("n_chars").cast("long"))


@query("SELECT conv_id, turn, text FROM conversations WHERE role = 'user'")
def staged_split(spark, d):
    root = scratch_path(spark, "staged")
    turns = table(spark, d, "conversations")
    for role in ("user", "assistant"):
        stage_dataset(turns.filter(F.col("role") == role), root, "chats", role)
    return read_dataset(spark, root, "chats", "user").select("conv_id", "turn", "text")


# --- parsing -------------------------------------------------------------------------------


def _answer(text: Column, record_id: Column) -> Column:
    """One text output line."""
    block = F.struct(F.lit("text").alias("type"), text.alias("text"))
    output = F.struct(F.array(block).alias("content"))
    return F.to_json(F.struct(record_id.alias("recordId"), output.alias("modelOutput")))


def _damaged_lines(spark: SparkSession, d: str) -> DataFrame:
    """An output line per document, damaged by language; one source wrote blanks only."""
    docs = table(spark, d, "documents")
    line = _answer(F.col("text"), F.col("doc_id").cast("string"))
    lang = F.col("lang")
    value = (
        F.when(F.col("source") == "src0", "   \t")
        .when(lang == "de", F.expr("concat('x', text)"))
        .when(lang == "es", F.concat(line, F.lit("] trailing")))
        .when(lang == "fr", F.concat(F.lit("  "), line, F.lit(" \r")))
        .otherwise(line)
    )
    return docs.select("doc_id", "lang", value.alias("value"))


@query(
    "SELECT doc_id, CAST(doc_id AS VARCHAR) AS record_id, text AS response FROM documents "
    "WHERE source <> 'src0' AND lang IN ('en', 'fr')"
)
def parse_outputs(spark, d):
    adapter = adapter_for(TEXT_MODEL)
    good, _ = split_good_bad(parse_lines(_damaged_lines(spark, d), adapter.output_schema))
    return good.select("doc_id", F.col("parsed.recordId").alias("record_id"), adapter.response(F.col("parsed")).alias("response"))


@query(
    "SELECT doc_id, 'not a JSON object' AS error FROM documents WHERE source <> 'src0' AND lang IN ('de', 'es')"
)
def quarantine_bad_lines(spark, d):
    _, bad = split_good_bad(parse_lines(_damaged_lines(spark, d), adapter_for(TEXT_MODEL).output_schema))
    return bad.select("doc_id", "error")


@query(
    f"SELECT CAST(ordinal // {SIZE} AS INTEGER) AS chunk_idx, ordinal % {SIZE} + 1 AS line_number, lang, source "
    f"FROM ({ORDINALS}) WHERE lang = 'de'"
)
def bad_line_numbers(spark, d):
    """Lines that are not JSON, with file and line number: a text file per chunk, so the work spreads over tasks."""
    path = scratch_path(spark, "lines")
    docs = stamped(spark, d)
    good = F.to_json(F.struct(F.col("doc_id").cast("string").alias("recordId")))
    line = F.when(F.col("lang") == "de", F.concat_ws(" ", "lang", "source")).otherwise(good)
    write_requests(docs.select("chunk_idx", "ordinal", line.alias("value")), path)
    scan = spark.read.text(path)
    bad = number_lines(scan, strict_json(F.col("value"), "recordId string").isNull())
    words = F.split("value", " ")
    return bad.select(
        path_chunk_idx(F.col("file_path")).alias("chunk_idx"),
        "line_number",
        words[0].alias("lang"),
        words[1].alias("source"),
    )


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    """Lines whose answer has three content blocks: language, source, text."""
    blocks = F.array(*[F.struct(F.lit("text").alias("type"), F.col(c).alias("text")) for c in ("lang", "source", "text")])
    line = F.struct(
        F.col("doc_id").cast("string").alias("recordId"),
        F.struct(blocks.alias("content")).alias("modelOutput"),
    )
    return table(spark, d, "documents").select("doc_id", F.to_json(line).alias("value"))


@query("SELECT doc_id, text AS response FROM documents")
def extract_text_last(spark, d):
    adapter = adapter_for(TEXT_MODEL)
    parsed = parse_lines(_blocks(spark, d), adapter.output_schema)
    return parsed.select("doc_id", adapter.response(F.col("parsed")).alias("response"))


@query(
    "SELECT doc_id, lang AS response, n_chars AS input_tokens, doc_id AS output_tokens, 'end_turn' AS stop_reason "
    "FROM documents"
)
def extract_text_first(spark, d):
    """Inline answers: the first block counts, usage is kept."""
    adapter = adapter_for(TEXT_MODEL)
    blocks = F.array(*[F.struct(F.lit("text").alias("type"), F.col(c).alias("text")) for c in ("lang", "text")])
    usage = F.struct(F.col("n_chars").alias("input_tokens"), F.col("doc_id").alias("output_tokens"))
    body = F.struct(blocks.alias("content"), usage.alias("usage"), F.lit("end_turn").alias("stop_reason"))
    lines = table(spark, d, "documents").select("doc_id", F.to_json(body).alias("value"))
    parts = adapter.inline_response(F.col("parsed"))
    return parse_lines(lines, adapter.inline_schema).select(
        "doc_id", parts["response"].alias("response"), parts["usage"]["input_tokens"].alias("input_tokens"),
        parts["usage"]["output_tokens"].alias("output_tokens"), parts["stop_reason"].alias("stop_reason"),
    )


def _vector_lines(spark: SparkSession, d: str) -> DataFrame:
    vector = F.col("embedding").cast("array<double>")
    line = F.struct(
        F.col("vec_id").cast("string").alias("recordId"), F.struct(vector.alias("embedding")).alias("modelOutput")
    )
    return table(spark, d, "embeddings").select("vec_id", F.to_json(line).alias("value"))


@query(
    "SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS x FROM "
    "(SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)"
)
def extract_embedding(spark, d):
    adapter = adapter_for(EMBEDDING_MODEL)
    parsed = parse_lines(_vector_lines(spark, d), adapter.output_schema)
    vectors = parsed.select("vec_id", adapter.response(F.col("parsed")).alias("embedding"))
    return vectors.select("vec_id", F.posexplode("embedding").alias("pos", "x"))


@query("SELECT vec_id, CAST(label AS BIGINT) AS token_count, CAST(len(embedding) AS INTEGER) AS dimensions FROM embeddings")
def embed_inline(spark, d):
    adapter = adapter_for(EMBEDDING_MODEL)
    body = F.struct(F.col("embedding"), F.col("label").alias("inputTextTokenCount"))
    lines = table(spark, d, "embeddings").select("vec_id", F.to_json(body).alias("value"))
    parts = adapter.inline_response(F.col("parsed"))
    return parse_lines(lines, adapter.inline_schema).select(
        "vec_id", parts["token_count"].alias("token_count"), F.size(parts["embedding"]).alias("dimensions")
    )


@query(
    "SELECT doc_id, CASE lang WHEN 'en' THEN NULL WHEN 'fr' THEN 'empty content' WHEN 'de' THEN 'missing content' "
    "ELSE NULL END AS problem, CASE lang WHEN 'en' THEN text END AS response FROM documents"
)
def answer_problems(spark, d):
    """Usable lines and unusable ones: empty content, no content, and no output at all (a null answer)."""
    adapter = adapter_for(TEXT_MODEL)
    docs = table(spark, d, "documents")
    rid = F.col("doc_id").cast("string")
    head = F.concat(F.lit('{"recordId":"'), rid, F.lit('"'))
    lang = F.col("lang")
    value = (
        F.when(lang == "en", _answer(F.col("text"), rid))
        .when(lang == "fr", F.concat(head, F.lit(',"modelOutput":{"content":[]}}')))
        .when(lang == "de", F.concat(head, F.lit(',"modelOutput":{}}')))
        .otherwise(F.concat(head, F.lit("}")))
    )
    parsed = parse_lines(docs.select("doc_id", value.alias("value")), adapter.output_schema)
    p = F.col("parsed")
    problem = adapter.problem(p, F.col("value"))
    return parsed.select(
        "doc_id", problem.alias("problem"), F.when(problem.isNull(), adapter.response(p)).alias("response")
    )


# --- collecting ----------------------------------------------------------------------------


def _labelled_answers(spark: SparkSession, rows: DataFrame, d: str) -> DataFrame:
    """Output lines for the rows whose document has a label."""
    labels = table(spark, d, "labels")
    verdict = F.concat(F.lit("quality="), F.col("quality"), F.lit(" toxic="), F.col("toxic"))
    return rows.join(labels, "doc_id").select(
        "chunk_idx", F.concat(F.lit("job-"), F.col("chunk_idx")).alias("job_id"),
        _answer(verdict, F.col("record_id")).alias("value"),
    )


def _extracted(spark: SparkSession, rows: DataFrame, d: str) -> DataFrame:
    lines = _labelled_answers(spark, rows, d).withColumn("file_path", F.lit(None).cast("string"))
    return extract(lines, adapter_for(TEXT_MODEL)).select("chunk_idx", "record_id", "response")


def _write_outputs(answers: DataFrame, path: str, mode: str = "error") -> None:
    """Output files as a service leaves them: one per job. ``overwrite`` replaces the given jobs' files only."""
    writer = by_chunk(answers).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("chunk_idx", "job_id").text(path)


def _read_answers(spark: SparkSession, spec: JobSpec) -> DataFrame:
    with listings(spark):
        return spark.read.text(spec.layout.outputs)


def _labelled_run(spark: SparkSession, d: str, name: str) -> JobSpec:
    """Prepare a run over all documents and write the output files a service would leave."""
    spec = spec_for(d, root=scratch_path(spark, name), **RUN)
    prepare(spark, spec)
    _write_outputs(_labelled_answers(spark, read_inputs(spark, spec.layout.inputs), d), spec.layout.outputs)
    return spec


VERDICT = "'quality=' || quality || ' toxic=' || toxic"
JOINED = (
    f"SELECT s.record_id, {VERDICT} AS response, s.doc_id, s.text, s.lang, s.chunk_idx "
    f"FROM ({STAMPED}) s JOIN labels l ON s.doc_id = l.doc_id"
)
RUN_JOINED = JOINED.replace(STAMPED, RUN_STAMPED)
RESULT_COLUMNS = ["record_id", "response", "doc_id", "text", "lang", "chunk_idx"]


@query(JOINED)
def join_answers(spark, d):
    rows = stamped(spark, d)
    return join_results(_extracted(spark, rows, d), rows, "response").select(*RESULT_COLUMNS)


@query(
    f"SELECT s.chunk_idx, s.record_id, 'input' AS side FROM ({STAMPED}) s "
    "WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = s.doc_id) "
    "UNION ALL SELECT 0 AS chunk_idx, 'label ' || doc_id AS record_id, 'output' AS side FROM labels WHERE toxic = 1"
)
def join_unmatched(spark, d):
    """Rows without an answer, and answers (one per toxic label) that belong to no row."""
    rows = stamped(spark, d)
    strangers = table(spark, d, "labels").filter("toxic = 1").select(
        F.lit(0).alias("chunk_idx"), F.concat(F.lit("label "), F.col("doc_id")).alias("record_id")
    )
    return unmatched(rows, _extracted(spark, rows, d).select("chunk_idx", "record_id").unionByName(strangers))


@query(
    f"SELECT s.record_id, {VERDICT} AS response_x, s.source AS response_y, s.doc_id "
    f"FROM ({STAMPED}) s JOIN labels l ON s.doc_id = l.doc_id"
)
def join_collision(spark, d):
    rows = stamped(spark, d)
    clashing = rows.withColumnRenamed("source", "response")
    return join_results(_extracted(spark, rows, d), clashing, "response").select(
        "record_id", "response_x", "response_y", "doc_id"
    )


OWN_IDS = f"SELECT doc_id, CAST(ordinal // {SIZE} AS INTEGER) AS chunk_idx, CAST(n_chars AS VARCHAR) AS record_id FROM ({ORDINALS})"


@query(
    f"SELECT a.chunk_idx, a.record_id, a.doc_id AS answered_doc, b.doc_id FROM ({OWN_IDS}) a JOIN ({OWN_IDS}) b "
    "ON a.chunk_idx = b.chunk_idx AND a.record_id = b.record_id"
)
def join_duplicate_ids(spark, d):
    """Own ids that repeat: they meet inside a chunk only."""
    rows = _own_ids(spark, d)
    answers = rows.select("chunk_idx", "record_id", F.col("doc_id").alias("answered_doc"))
    return join_results(answers, rows, "answered_doc").select("chunk_idx", "record_id", "answered_doc", "doc_id")


@query(f"SELECT chunk_idx, record_id, count(*) AS n_rows FROM ({OWN_IDS}) GROUP BY ALL HAVING count(*) > 1")
def repeated_ids(spark, d):
    return duplicate_ids(_own_ids(spark, d))


def _own_ids(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("record_id"))
    numbered = number_by_key(docs, ["doc_id"], unique=True)
    return with_record_id(assign_chunks(numbered, SIZE), "docs").select("doc_id", "chunk_idx", "record_id")


HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"


@query(f"SELECT 0 AS chunk_idx, {HOST} AS job_id, min(url) AS file_path FROM pages GROUP BY 2")
def first_output_file(spark, d):
    """Pages of a site stand for the files of a job."""
    files = table(spark, d, "pages").select(
        F.lit(0).alias("chunk_idx"),
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("job_id"),
        F.col("url").alias("file_path"),
    )
    return first_files(files)


@query(
    "SELECT CAST(doc_id AS VARCHAR) AS job_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
)
def jobs_without_output(spark, d):
    """Documents stand for completed jobs, labels for the files they left."""
    jobs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("job_id"))
    files = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("job_id"))
    return missing_outputs(jobs, files)


@query(RUN_JOINED)
def results_roundtrip(spark, d):
    """Whole run through files: inputs, requests, outputs, results, merged view."""
    spec = _labelled_run(spark, d, "results")
    run_collect(spark, spec)
    return read_results(spark, spec.layout.results).select(*RESULT_COLUMNS)


@query(RUN_JOINED)
def collect_lazy(spark, d):
    spec = _labelled_run(spark, d, "collect")
    return collect(spark, spec).select(*RESULT_COLUMNS)


@query(RUN_JOINED)
def collect_stream(spark, d):
    spec = _labelled_run(spark, d, "stream")
    return _stream(spark, spec).select(*RESULT_COLUMNS)


@query(
    f"SELECT s.chunk_idx, s.record_id, {VERDICT} AS response, s.doc_id FROM ({RUN_STAMPED}) s JOIN labels l "
    "ON s.doc_id = l.doc_id WHERE s.chunk_idx IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"
)
def collect_with_ledger(spark, d):
    """Only completed jobs are collected: a chunk's job completed if the customer of that number has an F order."""
    spec = _labelled_run(spark, d, "gated")
    table_ = run_collect(spark, spec, _run_ledger(spark, d, spec), on_missing="report")
    return good_results(table_).select("chunk_idx", "record_id", "response", "doc_id")


def _run_ledger(spark: SparkSession, d: str, spec: JobSpec) -> DataFrame:
    """A chunk's job completed if the customer of that number has an F order, else it failed."""
    jobs = spark.read.parquet(spec.layout.manifest).select(
        F.concat(F.lit("jobs/job-"), F.col("chunk_idx")).alias("job_arn"), "chunk_idx"
    )
    done = table(spark, d, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("chunk_idx"))
    done = done.distinct().withColumn("status", F.lit("Completed"))
    status = F.coalesce("status", F.lit("Failed"))
    return jobs.join(done, "chunk_idx", "left").select(
        "job_arn", "chunk_idx", status.alias("status"), failure_message(status).alias("error_message")
    )


def _stream(spark: SparkSession, spec: JobSpec, **options) -> DataFrame:
    at = spec.layout
    stream_collect(
        spark, at.outputs, at.inputs, at.results, scratch_path(spark, "stream-state"), adapter_for(TEXT_MODEL),
        glob=spec.output_glob, **options,
    ).awaitTermination()
    return read_results(spark, at.results)


F_CHUNKS = "(SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"


@query(
    f"SELECT s.chunk_idx, s.record_id, {VERDICT} AS response, s.doc_id FROM ({RUN_STAMPED}) s JOIN labels l "
    f"ON s.doc_id = l.doc_id WHERE s.chunk_idx IN {F_CHUNKS}"
)
def stream_gated(spark, d):
    """The stream takes output of completed jobs only, like the batch."""
    spec = _labelled_run(spark, d, "stream-gated")
    ledger = _run_ledger(spark, d, spec)
    return _stream(spark, spec, ledger=lambda _: ledger).select("chunk_idx", "record_id", "response", "doc_id")


@query(
    f"SELECT s.record_id, s.doc_id, {VERDICT} AS response FROM ({RUN_STAMPED}) s JOIN labels l ON s.doc_id = l.doc_id "
    f"UNION ALL SELECT s.record_id, s.doc_id, 'again' AS response FROM ({RUN_STAMPED}) s WHERE lang = 'de'"
)
def stream_two_jobs_per_chunk(spark, d):
    """A second job of each chunk arrives in later batches: answers of both stay."""
    spec = _labelled_run(spark, d, "two-jobs")
    saved = read_inputs(spark, spec.layout.inputs).filter(F.col("lang") == "de")
    more = saved.select(
        "chunk_idx", F.concat(F.lit("late-"), F.col("chunk_idx")).alias("job_id"),
        _answer(F.lit("again"), F.col("record_id")).alias("value"),
    )
    _write_outputs(more, spec.layout.outputs, "append")
    return _stream(spark, spec, files_per_batch=7).select("record_id", "doc_id", "response")


@query("SELECT doc_id, false AS answered FROM labels")
def rerun_same_prefix(spark, d):
    """Another run under the same prefix: answers to the first one match none of its rows."""
    spec = _labelled_run(spark, d, "rerun")
    prepare(spark, spec_for(d, root=spec.root, run_id="r2"))
    states = run_collect(spark, spec)
    answered = states.filter("state = 'ok'").select("doc_id", F.lit(True).alias("answered"))
    labels = table(spark, d, "labels").select("doc_id").join(answered, "doc_id", "left")
    return labels.select("doc_id", F.coalesce("answered", F.lit(False)).alias("answered"))


@query(
    f"SELECT s.chunk_idx, s.chunk_idx % 2 = 0 AS good, count(*) AS n_rows FROM ({RUN_STAMPED}) s JOIN labels l "
    "ON s.doc_id = l.doc_id GROUP BY ALL"
)
def chunk_rerun_turns_bad(spark, d):
    """Every other chunk is collected again after its output broke: nothing of its good rows remains."""
    spec = _labelled_run(spark, d, "turns-bad")
    run_collect(spark, spec)
    answers = _read_answers(spark, spec)
    odd = answers.filter("chunk_idx % 2 = 1").select("chunk_idx", "job_id", F.lit("{ broken").alias("value"))
    odd = materialize(odd, "broken")
    _write_outputs(odd, spec.layout.outputs, "overwrite")
    chunks = [r.chunk_idx for r in odd.select("chunk_idx").distinct().collect()]
    run_collect(spark, spec, chunks=chunks)
    with listings(spark):
        table_ = spark.read.parquet(spec.layout.results)
    return table_.groupBy("chunk_idx", (F.col("state") == "ok").alias("good")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    f"SELECT chunk_idx, CASE WHEN chunk_idx % 2 = 1 THEN 'second' ELSE 'first' END AS now, count(*) AS n_rows, "
    f"'first' AS before FROM ({RUN_JOINED}) GROUP BY ALL"
)
def results_snapshot(spark, d):
    """Every other chunk is collected anew; a reader that began before sees all of the first answers, also meanwhile."""
    spec = _labelled_run(spark, d, "snapshot")
    answers = _read_answers(spark, spec)
    first = read_after(spark, spec, answers, "first")
    odd = _read_answers(spark, spec).filter("chunk_idx % 2 = 1")
    chunks = [r.chunk_idx for r in odd.select("chunk_idx").distinct().collect()]
    read_after(spark, spec, odd, "second", chunks)
    now = read_results(spark, spec.layout.results).groupBy("chunk_idx", F.col("response").alias("now"))
    before = good_results(first).groupBy("chunk_idx").agg(F.max("response").alias("before"), F.min("response").alias("least"))
    both = now.agg(F.count(F.lit(1)).alias("n_rows")).join(before.filter("before = least"), "chunk_idx")
    return both.select("chunk_idx", "now", "n_rows", "before")


def read_after(spark: SparkSession, spec: JobSpec, answers: DataFrame, text: str, chunks: list[int] | None = None) -> DataFrame:
    """The results after all answers of the given lines were replaced by ``text``."""
    rid = F.get_json_object("value", "$.recordId")
    said = answers.select("chunk_idx", "job_id", _answer(F.lit(text), rid).alias("value"))
    said = materialize(said, "answers")
    _write_outputs(said, spec.layout.outputs, "overwrite")
    return run_collect(spark, spec, chunks=chunks, keep_replaced=True)


@query(
    "SELECT d.doc_id, d.lang AS \"State\", d.doc_id || '-' || d.n_chars AS record_id, d.source AS \"Response_y\", "
    "d.n_chars * 2 AS ordinal, l.quality AS quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
)
def carried_columns(spark, d):
    """Input columns named like columns of the run come back whole."""
    root = scratch_path(spark, "carried")
    rows = table(spark, d, "documents").select(
        "doc_id", "text", F.col("lang").alias("State"), F.concat_ws("-", "doc_id", "n_chars").alias("Record_ID"),
        F.col("source").alias("Response"), (F.col("n_chars") * 2).alias("ordinal"),
    )
    path = f"{root}/table.parquet"
    rows.write.parquet(path)
    spec = spec_for(d, root=root, input_uri=path, **RUN)
    prepare(spark, spec)
    saved = read_inputs(spark, spec.layout.inputs).join(table(spark, d, "labels"), "doc_id")
    answers = saved.select(
        "chunk_idx", F.concat(F.lit("job-"), F.col("chunk_idx")).alias("job_id"),
        _answer(F.col("quality").cast("string"), F.col("record_id")).alias("value"),
    )
    _write_outputs(answers, spec.layout.outputs)
    found = good_results(run_collect(spark, spec))
    return found.select(
        "doc_id", "State", "record_id", "Response_y", "ordinal",
        F.col("response_x").cast("int").alias("quality"),
    )


def _with_missing_texts(spark: SparkSession, d: str, name: str) -> JobSpec:
    """A prepared embedding run in which German rows and the whole second chunk have no text."""
    root = scratch_path(spark, name)
    gone = (F.col("lang") == "de") | F.col("doc_id").between(SIZE, 2 * SIZE - 1)
    rows = table(spark, d, "documents").select("doc_id", F.when(~gone, F.col("text")).alias("input_text"))
    path = f"{root}/texts.parquet"
    rows.write.parquet(path)
    spec = spec_for(d, root=root, input_uri=path, model_id=EMBEDDING_MODEL, prompt_id=None, **RUN)
    prepare(spark, spec)
    return spec


NO_TEXT = f"(lang = 'de' OR doc_id BETWEEN {SIZE} AND {2 * SIZE - 1})"


@query(
    f"SELECT doc_id, CAST(ordinal // {SIZE} AS INTEGER) AS chunk_idx FROM ({ORDINALS}) WHERE {NO_TEXT}"
)
def rejected_inputs_saved(spark, d):
    spec = _with_missing_texts(spark, d, "rejected")
    return spark.read.parquet(spec.layout.rejected_inputs).select("doc_id", "chunk_idx")


@query(
    f"SELECT CAST(ordinal // {SIZE} AS INTEGER) AS chunk_idx, count(*) AS n_records, count(*) FILTER (NOT {NO_TEXT}) "
    f"AS n_requests FROM ({ORDINALS}) GROUP BY 1 HAVING count(*) FILTER (NOT {NO_TEXT}) > 0"
)
def manifest_requests(spark, d):
    """A chunk without requests is no job; the others count records and requests."""
    spec = _with_missing_texts(spark, d, "counted")
    with listings(spark):
        scan = spark.read.text(spec.layout.requests)
    lines = scan.groupBy("chunk_idx").agg(F.count(F.lit(1)).alias("n_requests"))
    jobs = spark.read.parquet(spec.layout.manifest).select("chunk_idx", "n_records")
    return jobs.join(lines, "chunk_idx").select("chunk_idx", "n_records", "n_requests")


@query(
    f"SELECT 'lost-' || c AS job_id, c AS chunk_idx, 'no output file' AS error FROM "
    f"(SELECT DISTINCT CAST(ordinal // {SIZE} AS INTEGER) AS c FROM ({ORDINALS})) WHERE c IN {F_CHUNKS}"
)
def completed_without_output(spark, d):
    """A second, completed job per chunk left no file: the results say so."""
    spec = _labelled_run(spark, d, "lost")
    ledger = _run_ledger(spark, d, spec)
    lost = ledger.withColumn("job_arn", F.concat(F.lit("jobs/lost-"), F.col("chunk_idx")))
    table_ = run_collect(spark, spec, ledger.unionByName(lost), on_missing="report")
    missing = rejected_lines(table_).filter("state = 'missing' AND job_id LIKE 'lost-%'")
    return missing.select("job_id", "chunk_idx", "error")


@query(
    f"SELECT CASE WHEN lang IN ('de', 'es') THEN 'rejected' ELSE 'ok' END AS state, lang, count(*) AS n_rows "
    f"FROM ({STAMPED}) GROUP BY ALL"
)
def collect_states(spark, d):
    """Bad lines are kept in the results under their own state."""
    spec = spec_for(d, root=scratch_path(spark, "states"))
    prepare(spark, spec)
    saved = read_inputs(spark, spec.layout.inputs)
    rid = F.col("record_id")
    line = (
        F.when(F.col("lang") == "de", F.concat(F.lit('{"recordId":"'), rid, F.lit('","modelOutput":{"content":[]}}')))
        .when(F.col("lang") == "es", F.concat(F.lit('{"recordId":"'), rid, F.lit('","modelOutput":{}}')))
        .otherwise(_answer(F.col("text"), rid))
    )
    lines = saved.select("chunk_idx", F.concat(F.lit("job-"), F.col("chunk_idx")).alias("job_id"), line.alias("value"))
    _write_outputs(lines, spec.layout.outputs)
    states = run_collect(spark, spec)
    return states.groupBy("state", "lang").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    f"SELECT s.chunk_idx, count(*) AS n_records, count(l.doc_id) AS n_answers FROM ({STAMPED}) s "
    "LEFT JOIN labels l ON s.doc_id = l.doc_id GROUP BY 1"
)
def chunk_summary(spark, d):
    """Records and answers per chunk: numbering, requests' ids, strict parsing and the join in one plan."""
    rows = stamped(spark, d)
    answered = join_results(_extracted(spark, rows, d), rows.select("chunk_idx", "record_id"), "response")
    answers = answered.groupBy("chunk_idx").agg(F.count(F.lit(1)).alias("n_answers"))
    return records_per_chunk(rows).join(answers, "chunk_idx", "left").select(
        "chunk_idx", "n_records", F.coalesce("n_answers", F.lit(0)).alias("n_answers")
    )


# --- job states ----------------------------------------------------------------------------


STATUS_BY_TYPE = {
    "purchase": "Completed",
    "error": "Failed",
    "click": "InProgress",
    "signup": "PartiallyCompleted",
    "view": "Running",
}


def _status_events(spark: SparkSession, d: str, stream: bool = False) -> DataFrame:
    """Events as job-state events: a user is a job; views carry a state outside the list."""
    if stream:
        schema = spark.read.parquet(f"{d}/events.parquet").schema
        events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    else:
        events = table(spark, d, "events")
    status = F.lit(None).cast("string")
    for kind, state in STATUS_BY_TYPE.items():
        status = F.when(F.col("event_type") == kind, state).otherwise(status)
    return events.select(
        F.col("user_id").cast("string").alias("job_arn"),
        status.alias("status"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("event_id").alias("seq"),
    )


STATUS = (
    "CASE event_type WHEN 'purchase' THEN 'Completed' WHEN 'error' THEN 'Failed' WHEN 'click' THEN 'InProgress' "
    "WHEN 'signup' THEN 'PartiallyCompleted' ELSE 'Running' END"
)
STATUS_EVENTS = f"SELECT CAST(user_id AS VARCHAR) AS job_arn, {STATUS} AS status, ts AS event_ts, event_id AS seq FROM events"
LATEST = (
    "SELECT job_arn, arg_max(status, (event_ts, seq)) AS status, max(event_ts) AS event_ts, "
    f"arg_max(seq, (event_ts, seq)) AS seq FROM ({STATUS_EVENTS}) GROUP BY 1"
)
#: States outside the list change no ledger row.
LATEST_KNOWN = (
    "SELECT job_arn, arg_max(status, (event_ts, seq)) AS status "
    f"FROM ({STATUS_EVENTS}) WHERE status <> 'Running' GROUP BY 1"
)
CLASS = (
    "CASE WHEN status = 'Completed' THEN 'success' WHEN status IN ('Failed', 'PartiallyCompleted') THEN 'failure' "
    "WHEN status = 'InProgress' THEN 'heartbeat' END"
)
FAILED = "CASE WHEN status IN ('Failed', 'PartiallyCompleted') THEN status END"


@query(f"SELECT seq, {CLASS} AS class, {FAILED} AS error_message FROM ({STATUS_EVENTS})")
def classify_status(spark, d):
    return _status_events(spark, d).select(
        "seq", classify(F.col("status")).alias("class"), failure_message(F.col("status")).alias("error_message")
    )


@query(f"SELECT seq, job_arn, status FROM ({STATUS_EVENTS}) WHERE status = 'Running'")
def unknown_status(spark, d):
    return unknown_states(_status_events(spark, d)).select("seq", "job_arn", "status")


@query(f"SELECT job_arn, status, seq FROM ({LATEST})")
def latest_job_status(spark, d):
    return latest_status(_status_events(spark, d)).select("job_arn", "status", "seq")


@query(f"SELECT job_arn, status, seq FROM ({LATEST})")
def latest_status_stream(spark, d):
    log = scratch_path(spark, "status-log")
    fold_events(_status_events(spark, d, stream=True), log, scratch_path(spark, "status-state")).awaitTermination()
    return read_log(spark, log).select("job_arn", "status", "seq")


@query(
    f"SELECT job_arn AS job_id FROM ({LATEST}) WHERE status = 'Completed'"
)
def skip_failed_jobs(spark, d):
    newest = latest_status(_status_events(spark, d))
    return collectable_jobs(newest.withColumn("error_message", failure_message(F.col("status"))))


@query(
    f"SELECT job_arn AS job_id FROM ({LATEST}) WHERE status IN ('Completed', 'PartiallyCompleted')"
)
def accept_partial_jobs(spark, d):
    newest = latest_status(_status_events(spark, d))
    return collectable_jobs(newest.withColumn("error_message", failure_message(F.col("status"))), accept_partial=True)


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    """Customers as jobs in the ledger; the larger part of the event users are not among them."""
    return table(spark, d, "customer").select(
        (F.col("c_custkey") * 10).cast("string").alias("job_arn"),
        F.col("c_mktsegment").alias("model_id"),
        F.lit("Submitted").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )


LEDGER = "SELECT CAST(c_custkey * 10 AS VARCHAR) AS job_arn, c_mktsegment AS model_id FROM customer"


@query(
    "SELECT e.seq, e.job_arn, e.status, l.model_id, l.job_arn IS NOT NULL AS known "
    f"FROM ({STATUS_EVENTS}) e LEFT JOIN ({LEDGER}) l ON e.job_arn = l.job_arn"
)
def ledger_lookup(spark, d):
    return join_ledger(_status_events(spark, d), _ledger(spark, d)).select(
        "seq", "job_arn", "status", "model_id", "known"
    )


@query(
    "SELECT e.seq, e.job_arn, l.model_id, l.job_arn IS NOT NULL AND e.status <> 'Running' AS accepted "
    f"FROM ({STATUS_EVENTS}) e LEFT JOIN ({LEDGER}) l ON e.job_arn = l.job_arn"
)
def ledger_lookup_stream(spark, d):
    known, unknown, state = (scratch_path(spark, n) for n in ("known", "unknown", "route-state"))
    route_events(_status_events(spark, d, stream=True), _ledger(spark, d), known, unknown, state).awaitTermination()
    halves = [
        spark.read.parquet(path).select("seq", "job_arn", "model_id", F.lit(accepted).alias("accepted"))
        for path, accepted in ((known, True), (unknown, False))
    ]
    return halves[0].unionByName(halves[1])


@query(
    f"SELECT l.job_arn, l.model_id, coalesce(n.status, 'Submitted') AS status, CASE WHEN n.status IN ('Failed', "
    f"'PartiallyCompleted') THEN n.status END AS error_message FROM ({LEDGER}) l LEFT JOIN ({LATEST_KNOWN}) n ON l.job_arn = n.job_arn"
)
def updated_ledger(spark, d):
    return update_ledger(_ledger(spark, d), _status_events(spark, d))


@query(
    "SELECT chunk_idx, 'arn/' || chunk_idx AS job_arn, CAST(chunk_idx AS VARCHAR) AS job_id, "
    f"'{TEXT_MODEL}' AS model_id, '/data/docs/outputs/chunk_idx=' || chunk_idx AS outputs_path, 'Submitted' AS status "
    f"FROM (SELECT DISTINCT chunk_idx FROM ({STAMPED}))"
)
def submitted_ledger(spark, d):
    jobs = build_manifest(stamped(spark, d), spec_for(d, root="/data"))
    submissions = jobs.select(
        "job_name", F.concat(F.lit("arn/"), F.col("chunk_idx")).alias("job_arn"), F.lit("Submitted").alias("status")
    )
    rows = ledger_rows(jobs, submissions)
    return rows.select("chunk_idx", "job_arn", job_id(F.col("job_arn")).alias("job_id"), "model_id", "outputs_path", "status")


@query(
    "SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, time_bucket(INTERVAL '5 minutes', ts) + INTERVAL "
    "'5 minutes' AS window_end, count(*) AS n_failed FROM events WHERE event_type IN ('error', 'signup') GROUP BY ALL"
)
def failure_periods(spark, d):
    return failure_windows(_status_events(spark, d))


def _in_two_runs(spark: SparkSession, d: str, name: str, events: DataFrame, rows_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a stream with timers writes over events that arrive in two runs; a last event moves the clock past all."""
    inbox, out, state = (scratch_path(spark, f"{name}-{part}") for part in ("inbox", "out", "state"))
    events = materialize(events, f"{name}-events")
    first, middle, last = events.agg(
        F.min("event_ts"), F.timestamp_millis(F.avg(F.unix_millis("event_ts")).cast("long")), F.max("event_ts")
    ).first()
    end = F.lit(last) + F.expr("INTERVAL 10 DAYS")
    closing = [
        spark.range(1).select(
            F.lit("closing").alias("job_arn"), F.lit("Submitted").alias("status"),
            (end + F.make_dt_interval(days=F.lit(n))).alias("event_ts"), F.lit(n).cast("long").alias("seq"),
        )
        for n in range(2)
    ]
    parts = [events.filter(F.col("event_ts") <= F.lit(middle)), events.filter(F.col("event_ts") > F.lit(middle)), *closing]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(events.schema).parquet(inbox)
        write_timed(rows_of(stream), out, state).awaitTermination()
    return spark.read.parquet(out)


#: A user's events up to the first completed one are a job's; failures are left out, so that jobs last for days.
JOB_EVENTS = (
    "SELECT job_arn, status, event_ts, seq FROM (SELECT *, min(CASE WHEN status = 'Completed' THEN event_ts END) "
    f"OVER (PARTITION BY job_arn) AS ended FROM ({STATUS_EVENTS}) WHERE status NOT IN ('Failed', 'PartiallyCompleted')) "
    "WHERE ended IS NULL OR event_ts <= ended"
)


@query(
    "SELECT job_arn, 'Expired' AS status, s + INTERVAL 24 HOURS AS event_ts FROM ("
    "SELECT job_arn, date_trunc('millisecond', min(event_ts)) AS s, min(CASE WHEN status = 'Completed' THEN "
    "date_trunc('millisecond', event_ts) END) AS e "
    f"FROM ({JOB_EVENTS}) WHERE status <> 'Running' GROUP BY job_arn) WHERE e IS NULL OR e > s + INTERVAL 24 HOURS"
)
def job_timeouts(spark, d):
    """Jobs without a final state a day after their first event, by timers of a stream that was restarted midway."""
    events = _status_events(spark, d).filter("status NOT IN ('Failed', 'PartiallyCompleted')")
    ended = F.min(F.when(F.col("status") == "Completed", F.col("event_ts"))).over(Window.partitionBy("job_arn"))
    jobs = events.withColumn("ended", ended).filter("ended IS NULL OR event_ts <= ended").drop("ended")
    found = _in_two_runs(spark, d, "timeouts", jobs, expired_jobs)
    return found.filter("job_arn <> 'closing'").select("job_arn", "status", "event_ts")


@query(
    "WITH w AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS p, count(*) AS n FROM events "
    "WHERE event_type IN ('error', 'signup') GROUP BY 1), "
    "m AS (SELECT *, lag(p) OVER (ORDER BY p) AS before, lead(p) OVER (ORDER BY p) AS after FROM w) "
    "SELECT 'ALARM' AS state, p + INTERVAL 5 MINUTES AS at, n AS n_failed FROM m "
    "WHERE before IS NULL OR before < p - INTERVAL 5 MINUTES UNION ALL "
    "SELECT 'OK', p + INTERVAL 10 MINUTES, 0 FROM m WHERE after IS NULL OR after > p + INTERVAL 5 MINUTES"
)
def alarm_changes(spark, d):
    """The failure alarm going on and off, by timers of a stream that was restarted midway."""
    found = _in_two_runs(spark, d, "alarm", _status_events(spark, d), alarm_transitions)
    return found.select("state", "at", "n_failed")


# --- inline scoring ------------------------------------------------------------------------


def sample_text_client() -> Callable[[str], str]:
    """Deterministic stand-in for a text model: tells the prompt's length, refuses prompts with an ``@``."""

    def answer(body: str) -> str:
        prompt = json.loads(body)["messages"][0]["content"]
        if "@" in prompt:
            raise RuntimeError("request refused")
        return json.dumps(
            {
                "content": [{"type": "text", "text": f"{len(prompt)} characters"}],
                "usage": {"input_tokens": len(prompt), "output_tokens": 2},
                "stop_reason": "end_turn",
            }
        )

    return answer


def sample_embedding_client() -> Callable[[str], str]:
    """Deterministic stand-in for an embedding model."""

    def answer(body: str) -> str:
        text = json.loads(body)["inputText"]
        if "@" in text:
            raise RuntimeError("request refused")
        return json.dumps({"embedding": [float(len(text)), float(text.count(" "))], "inputTextTokenCount": len(text)})

    return answer


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return score_text(table(spark, d, "documents"), sample_text_client, "{lang}: {text}", with_usage=True)


def _scored_once(spark: SparkSession, d: str, name: str) -> DataFrame:
    return score_to(_scored(spark, d), scratch_path(spark, name))


REFUSED = "contains(text, '@')"


@query(
    f"SELECT doc_id, lang, CASE WHEN NOT {REFUSED} THEN (length(text) + 4) || ' characters' END AS response, "
    f"NOT {REFUSED} AS success, CASE WHEN {REFUSED} THEN 'request refused' END AS error FROM documents"
)
def score_documents(spark, d):
    return _scored(spark, d).select("doc_id", "lang", "response", "success", "error")


@query(
    f"SELECT doc_id, CASE WHEN NOT {REFUSED} THEN CAST(length(text) AS DOUBLE) END AS n_characters, "
    f"CASE WHEN NOT {REFUSED} THEN CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) END AS n_spaces, "
    f"CASE WHEN {REFUSED} THEN 0 ELSE length(text) END AS token_count, NOT {REFUSED} AS success, "
    f"CASE WHEN {REFUSED} THEN 'request refused' END AS error FROM documents WHERE lang <> 'de'"
)
def score_embedding_texts(spark, d):
    rows = table(spark, d, "documents").select(
        "doc_id", F.when(F.col("lang") != "de", F.col("text")).otherwise("").alias("input_text")
    )
    scored = score_embeddings(rows, sample_embedding_client)
    return scored.select(
        "doc_id", F.col("embedding")[0].alias("n_characters"), F.col("embedding")[1].alias("n_spaces"), "token_count",
        "success", "error",
    )


@query(f"SELECT doc_id, NOT {REFUSED} AS success FROM documents WHERE lang <> 'en'")
def score_skips_missing_fields(spark, d):
    rows = table(spark, d, "documents").withColumn("lang", F.nullif("lang", F.lit("en")))
    return score_text(rows, sample_text_client, "{lang}: {text}").select("doc_id", "success")


@query(
    f"SELECT doc_id, (length(text) + 4) || ' characters' AS response, true AS success, NULL::VARCHAR AS error "
    f"FROM documents WHERE {REFUSED}"
)
def rescore_failed(spark, d):
    """Rows that failed are scored again, without the sign the model refuses; their old results are replaced."""
    failed = _scored_once(spark, d, "first-round").filter("not success")
    mended = failed.withColumn("text", F.replace("text", F.lit("@"), F.lit("#")))
    again = score_text(mended, sample_text_client, "{lang}: {text}", with_usage=True)
    return score_to(again, scratch_path(spark, "second-round")).select("doc_id", "response", "success", "error")


def strict_text_client() -> Callable[[str], str]:
    """Deterministic stand-in for a text model that takes every prompt."""
    return lambda body: json.dumps(
        {"content": [{"text": f"{len(json.loads(body)['messages'][0]['content'])} characters"}]}
    )


def busy_text_client() -> Callable[[str], str]:
    """Deterministic stand-in for a busy service: it puts a prompt off as often as its length modulo 4 says."""
    seen: dict[str, int] = {}

    def answer(body: str) -> str:
        prompt = json.loads(body)["messages"][0]["content"]
        seen[body] = seen.get(body, 0) + 1
        if seen[body] <= len(prompt) % 4:
            raise Throttled("rate exceeded")
        del seen[body]
        return json.dumps({"content": [{"text": f"{len(prompt)} characters"}]})

    return answer


@query(
    f"SELECT doc_id, (length(text) + 4) || ' characters' AS response, true AS success, "
    f"CASE WHEN {REFUSED} THEN 1 ELSE 0 END AS run FROM documents"
)
def score_resume(spark, d):
    """A run that some calls failed in, taken up by a second one: only those calls are made again."""
    log = scratch_path(spark, "call-log")
    docs = table(spark, d, "documents")
    n = math.ceil(docs.count() / 4)
    score_text(docs, sample_text_client, "{lang}: {text}", log=log, wave_calls=n)
    scored = score_text(docs, strict_text_client, "{lang}: {text}", log=log, wave_calls=n)
    body = F.to_json(adapter_for(TEXT_MODEL).inline_request(render(docs, "{lang}: {text}"), max_tokens=fixed.INLINE_MAX_TOKENS))
    runs = finished_calls(spark, log).select("call_key", "call.run")
    keyed = scored.withColumn("call_key", call_keys(body))
    return keyed.join(runs, "call_key").select("doc_id", "response", "success", "run")


@query(
    "SELECT doc_id, CASE WHEN n % 4 < 3 THEN n || ' characters' END AS response, n % 4 < 3 AS success, "
    "CASE WHEN n % 4 = 3 THEN 'rate exceeded' END AS error, CAST(least(n % 4 + 1, 3) AS INTEGER) AS tries "
    "FROM (SELECT doc_id, length(doc_id || ': ' || text) AS n FROM documents)"
)
def score_throttled(spark, d):
    """A service that throttles: calls are made again at a slower pace, those put off too often fail in their row."""
    scored = score_text(
        table(spark, d, "documents"), busy_text_client, "{doc_id}: {text}", attempts=3, backoff=0.0,
        requests_per_second=1_000_000, in_flight=4, with_tries=True, hold=0.0, floor=0.5,
    )
    return scored.select("doc_id", "response", "success", "error", "tries")


@query(
    f"SELECT count(*) AS processed, count(*) FILTER (NOT {REFUSED}) AS successful, "
    f"count(*) FILTER ({REFUSED}) AS failed FROM documents"
)
def score_counts(spark, d):
    return score_summary(_scored_once(spark, d, "counts"))


@query(
    f"SELECT doc_id, (length(text) + 4) || ' characters' AS response FROM documents WHERE NOT {REFUSED} "
    "ORDER BY doc_id LIMIT 1"
)
def first_success(spark, d):
    return sample_success(_scored_once(spark, d, "sample"), ["doc_id"]).select("doc_id", "response")


@query(
    "SELECT lang AS model_id, count(*) AS n_records, CAST(sum(length(text) + 4) AS BIGINT) AS input_tokens, "
    "CAST(count(*) * 2 AS BIGINT) AS output_tokens, round(sum(length(text) + 4) * p / 1000 + count(*) * 2 * q / 1000, 6) AS usd "
    "FROM documents LEFT JOIN (VALUES ('en', 0.00025, 0.00125), ('fr', 0.003, 0.015), ('de', 0.00002, NULL)) v(m, p, q0) "
    f"ON lang = m, LATERAL (SELECT coalesce(q0, 0) AS q) WHERE NOT {REFUSED} GROUP BY lang, p, q"
)
def cost_estimate(spark, d):
    """Token cost with the language standing for the model; one language has no price."""
    scored = _scored_once(spark, d, "cost").filter("success")
    usage = scored.select(F.col("lang").alias("model_id"), "usage.*")
    prices = spark.createDataFrame(
        [("en", 0.00025, 0.00125), ("fr", 0.003, 0.015), ("de", 0.00002, None)],
        "model_id string, usd_per_1k_in double, usd_per_1k_out double",
    )
    return estimate_cost(usage, prices).withColumn("usd", F.round("usd", 6))


@query("SELECT doc_id, text[1:100] AS input, text[1:200] AS response FROM documents")
def previews(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", input_preview(F.col("text")).alias("input"), response_preview(F.col("text")).alias("response")
    )


@query(
    f"SELECT doc_id, lang, CASE WHEN NOT {REFUSED} THEN chr(10) || '  ' || (length(text) + 4) || ' characters' || chr(9) || ' ' END "
    f"AS response, CASE WHEN {REFUSED} THEN 'false' ELSE 'true' END AS success FROM documents"
)
def csv_results(spark, d):
    """Scored rows written as CSV and read back, nested columns as JSON; answers begin and end in white space."""
    path = scratch_path(spark, "scored") + ".csv"
    padded = F.concat(F.lit("\n  "), F.col("response"), F.lit("\t "))
    write_csv(_scored(spark, d).withColumn("response", padded), path)
    rows = read_input(spark, path)
    return rows.select(F.col("doc_id").cast("long"), "lang", "response", "success")
