import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotwise.functions.jsonlines import parse_lines, split_good_bad, strict_json, stripped
from lotwise.sources.outputs import locate_bad_lines

SCHEMA = "recordId string, n int"


def is_object(line):
    try:
        return isinstance(json.loads(line), dict)
    except ValueError:
        return False


LINES = [
    '{"recordId":"a","n":1}',
    '{"recordId":"a"}]',
    '{"recordId":"a"}] tail',
    '{"recordId":"a"}} tail',
    '{"recordId":"a"}]}',
    '{"recordId":"a"},{"recordId":"b"}',
    '{"recordId":"a"}{"recordId":"b"}',
    '{"recordId":"a"},"n":1} tail',
    '{"recordId":"a"},"n":1',
    '{"recordId":"a"}],"n":1}',
    "{'recordId':\"a\"}",
    '{"recordId":"a",}',
    '{"recordId":"a"},',
    '{"recordId":01}',
    '{"recordId":"tab\tinside"}',
    '{"recordId":"a"} // note',
    '{"recordId":"\\u00e9\\ud83d\\ude00"}',
    '{"x":NaN}',
    '{"x":{"y":[1,{"z":null}]}}',
    "{}",
    "[]",
    '[{"recordId":"a"}]',
    "null",
    "1",
    '"text"',
    "not-json",
    "{",
]


def test_agrees_with_a_strict_parser(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1)
    got = [r[0] for r in df.select(strict_json(F.col("value"), SCHEMA).isNotNull()).collect()]
    assert dict(zip(LINES, got)) == {x: is_object(x) for x in LINES}


pieces = st.sampled_from(['{"recordId":"a"}', "{", "}", "[", "]", ",", ":", '"n"', "1", " ", '"v"', "null", '{"n":2}'])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(pieces, min_size=1, max_size=6).map("".join), min_size=200, max_size=400))
def test_agrees_with_a_strict_parser_on_scraps(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    got = [r[0] for r in df.select(strict_json(stripped(F.col("value")), SCHEMA).isNotNull()).collect()]
    assert got == [is_object(x.strip()) for x in lines]


@pytest.mark.parametrize("edge", [" ", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", " \r  "])
def test_strips_what_python_strips(spark, edge):
    raw = f"{edge}a b{edge}"
    assert spark.createDataFrame([(raw,)], "v string").select(stripped(F.col("v"))).first()[0] == raw.strip()


def test_zero_width_space_is_kept(spark):
    raw = "​x﻿"
    assert spark.createDataFrame([(raw,)], "v string").select(stripped(F.col("v"))).first()[0] == raw.strip() == raw


def test_blank_lines_are_dropped_and_bad_ones_kept(spark):
    lines = spark.createDataFrame([('{"n":1}',), ("",), ("  \t\r",), ("oops",)], "value string").coalesce(1)
    good, bad = split_good_bad(parse_lines(lines, SCHEMA))
    assert [r.parsed.n for r in good.collect()] == [1]
    assert [(r.value, r.error) for r in bad.collect()] == [("oops", "not a JSON object")]


def test_line_numbers_count_blank_lines_over_many_splits(spark, tmp_path):
    lines = ['{"n":%d}' % i if i % 5 else "" for i in range(2000)]
    for i in (3, 777, 1999):
        lines[i] = f"bad {i}"
    (tmp_path / "a.txt").write_text("\n".join(lines))
    (tmp_path / "b.txt").write_text("\n".join(["", "only bad", '{"n":1}']))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = locate_bad_lines(spark, [str(tmp_path)], SCHEMA).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {(r.file_path.split("/")[-1], r.line_number, r.value) for r in found}
    assert got == {("a.txt", i + 1, f"bad {i}") for i in (3, 777, 1999)} | {("b.txt", 2, "only bad")}


def test_bytes_that_are_not_utf8_make_a_bad_line(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b'{"recordId":"ok \xc3\xa9"}\n{"recordId":"bad \xff"}\n')
    good, bad = split_good_bad(parse_lines(spark.read.text(str(tmp_path)), SCHEMA))
    assert [r.parsed.recordId for r in good.collect()] == ["ok é"]
    assert bad.count() == 1
