import datetime as dt
import decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lotwise.functions.prompts import (
    PromptTemplate,
    check_columns,
    prompt_ids,
    register_prompt,
    render,
    required_columns,
    resolve_prompt,
)


def rendered(df, text, policy="literal"):
    return [r[0] for r in df.select(render(df, text, policy)).collect()]


@pytest.mark.parametrize(
    "text,fields",
    [
        ("Write about {topic} as {style}", {"topic", "style"}),
        ("{a} {b:.100} {c!s}", {"a", "b", "c"}),
        ("nothing to fill", set()),
        ("{{x}} {y}", {"y"}),
    ],
)
def test_fields(text, fields):
    assert PromptTemplate.parse(text).fields == fields


@pytest.mark.parametrize("text", ["{}", "{0}", "{a.b}", "{a[0]}", "{a:{b}}"])
def test_fields_that_no_column_can_fill(text):
    with pytest.raises(ValueError):
        PromptTemplate.parse(text)


def test_registry():
    with pytest.raises(ValueError, match="need a prompt_id"):
        resolve_prompt("text", None)
    with pytest.raises(ValueError, match="available: .*tone_of_text"):
        resolve_prompt("text", "no-such-prompt")
    assert resolve_prompt("embedding", None) is None
    register_prompt("shout", "SAY {word}!")
    assert "shout" in prompt_ids()
    assert resolve_prompt("text", "shout").fields == {"word"}
    with pytest.raises(ValueError):
        register_prompt("bad", "{}")


def test_missing_columns_are_listed_in_order(spark):
    df = spark.createDataFrame([("x",)], "topic string")
    with pytest.raises(ValueError, match=r"\['a', 'z'\]"):
        check_columns(df, {"z", "a", "topic"})
    with pytest.raises(ValueError, match="input_text"):
        check_columns(df, required_columns("embedding", None))


def test_values_are_not_scanned_for_fields(spark):
    df = spark.createDataFrame([("{b}", "B")], "a string, b string")
    assert rendered(df, "{{a}}={a} b={b}") == ["{a}={b} b=B"]


VALUES = [
    ("double", [1e16, 0.1, 1.0, float("nan"), float("-inf")]),
    ("float", [0.5, 2.0]),
    ("boolean", [True, False]),
    ("long", [3, -7]),
    ("int", [3, 12345]),
    ("string", ["plain", "ünï 😀", ""]),
    ("date", [dt.date(2024, 2, 29)]),
    ("timestamp", [dt.datetime(2024, 2, 29, 1, 2, 3), dt.datetime(2024, 2, 29, 1, 2, 3, 400)]),
    ("decimal(10,2)", [decimal.Decimal("1.50"), decimal.Decimal("-0.10")]),
]


@pytest.mark.parametrize("dtype,values", VALUES)
def test_text_is_pythons(spark, dtype, values):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}").coalesce(1)
    for template in ("<{v}>", "<{v!s}>", "<{v!r}>", "<{v!s:>12}>", "<{v!s:.3}>"):
        if "!r" in template and dtype in ("date", "timestamp", "decimal(10,2)"):
            continue
        assert rendered(df, template) == [template.format(v=v) for v in values]


def test_specs(spark):
    df = spark.createDataFrame([("abcdef", 7, 3.14159), ("é😀x", None, None)], "s string, n int, x double").coalesce(1)
    assert rendered(df, "{s:.2}|{s:>8}|{s:^8}|{n:04d}|{x:.2f}") == [
        "ab|  abcdef| abcdef |0007|3.14",
        "é😀|     é😀x|  é😀x   |None|None",
    ]


def test_null_policies(spark):
    df = spark.createDataFrame([("x",), (None,)], "v string").coalesce(1)
    assert rendered(df, "<{v}>", "literal") == ["<x>", "<None>"]
    assert rendered(df, "<{v}>", "empty") == ["<x>", "<>"]
    assert rendered(df, "<{v}>", "drop") == ["<x>", None]
    with pytest.raises(PySparkException, match='null in template field "v"'):
        rendered(df, "<{v}>", "fail")
    with pytest.raises(ValueError):
        render(df, "<{v}>", "ignore")


def test_null_integers_stay_integers(spark):
    df = spark.createDataFrame([(1,), (None,)], "n int").coalesce(1)
    assert rendered(df, "{n}") == ["1", "None"]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1,)], "`my col` int")
    assert rendered(df, "{my col}!") == ["1!"]


def test_plain_templates_need_no_python(spark):
    df = spark.createDataFrame([("a", 1, True)], "s string, n long, b boolean")
    plan = df.select(render(df, "{s} {s:.3} {n!s} {b}"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_nested_values_render_as_json(spark):
    df = spark.range(1).select(F.array(F.lit(1), F.lit(2)).alias("v"))
    assert rendered(df, "{v}") == ["[1,2]"]
    with pytest.raises(ValueError):
        render(df, "{v:>5}")
