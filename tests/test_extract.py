"""Answers taken from random output lines, against a few lines of plain Python."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotwise.functions.adapters import EmbeddingAdapter, MessagesAdapter
from lotwise.plans.collect import extract

BAD = "bad"
words = st.text(st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=8)
texts = st.one_of(words, st.none())
block = st.one_of(
    st.fixed_dictionaries({"text": texts}, optional={"type": words}),
    st.fixed_dictionaries({"type": words}),
    st.none(),
)
content = st.one_of(st.lists(block, max_size=3), st.none(), words)
text_output = st.one_of(st.fixed_dictionaries({}, optional={"content": content, "stop": words}), st.none(), words)
vector = st.one_of(
    st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False), st.integers(-9, 9)), max_size=4),
    st.lists(st.one_of(st.floats(0, 1), st.none()), max_size=3),
    st.none(),
    words,
)
vector_output = st.one_of(st.fixed_dictionaries({}, optional={"embedding": vector}), st.none(), words)
ids = st.one_of(words, st.none())


def lines(output):
    record = st.fixed_dictionaries({}, optional={"recordId": ids, "modelOutput": output, "other": words})
    spaced = st.tuples(record, st.sampled_from(["", " ", "\t", "\r", " "])).map(
        lambda p: p[1] + json.dumps(p[0], ensure_ascii=False) + p[1]
    )
    return st.lists(st.one_of(spaced, spaced, words), min_size=100, max_size=200)


def text_of(record):
    if "modelOutput" not in record:
        return None
    last = record["modelOutput"]["content"][-1]
    if not isinstance(last, dict):
        raise TypeError
    return last["text"]


def vector_of(record):
    values = record["modelOutput"]["embedding"]
    if not isinstance(values, list):
        raise TypeError
    return [float(v) for v in values]


def expected(line, answer):
    if not line.strip():
        return None
    try:
        record = json.loads(line)
        if record["recordId"] is None:
            return BAD
        return record["recordId"], answer(record)
    except (ValueError, KeyError, TypeError, IndexError):
        return BAD


def check(spark, adapter, batch, answer):
    # A line has no line break inside.
    batch = [line.replace("\n", " ") for line in batch]
    rows = spark.createDataFrame(list(enumerate(batch)), "chunk_idx int, value string")
    rows = rows.select("*", F.lit("j").alias("job_id"), F.lit("f").alias("file_path"))
    got = {}
    for r in extract(rows, adapter).collect():
        got[r.chunk_idx] = BAD if r.error is not None else (r.record_id, r[adapter.result_column])
    assert got == {i: e for i, line in enumerate(batch) if (e := expected(line, answer)) is not None}


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines(text_output))
def test_text_answers(spark, batch):
    check(spark, MessagesAdapter(), batch, text_of)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines(vector_output))
def test_vectors(spark, batch):
    check(spark, EmbeddingAdapter(), batch, vector_of)
