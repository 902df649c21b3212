import json

import pytest
from pyspark.sql import functions as F

from lotwise.functions import adapters
from lotwise.functions.adapters import EmbeddingAdapter, MessagesAdapter, ModelAdapter, adapter_for, register_adapter
from lotwise.functions.jsonlines import parse_lines

TEXT = "anthropic.sample-v1"
VECTOR = "amazon.titan-embed-text-v2:0"


def request(spark, adapter, **options):
    row = spark.range(1).select(F.to_json(adapter.request(F.lit('say "hi"\né'), F.lit("r1"), **options)))
    return json.loads(row.first()[0])


def test_text_request(spark):
    expected = {
        "recordId": "r1",
        "modelInput": {
            "anthropic_version": "bedrock-2023-05-31",
            "max_tokens": 1024,
            "messages": [{"role": "user", "content": [{"type": "text", "text": 'say "hi"\né'}]}],
        },
    }
    assert request(spark, MessagesAdapter()) == expected
    expected["modelInput"]["max_tokens"] = 5
    assert request(spark, MessagesAdapter(), max_tokens=5, temperature=0.1, top_p=0.9) == expected


def test_embedding_request(spark):
    assert request(spark, EmbeddingAdapter()) == {"recordId": "r1", "modelInput": {"inputText": 'say "hi"\né'}}
    options = {"dimensions": 512, "normalize": True, "tags": ["a"], "more": {"k": 1.5}}
    assert request(spark, EmbeddingAdapter(), **options)["modelInput"] == {"inputText": 'say "hi"\né', **options}


def test_model_ids():
    assert isinstance(adapter_for(TEXT), MessagesAdapter)
    assert isinstance(adapter_for("eu." + VECTOR), EmbeddingAdapter)
    for model_id in ("Anthropic.x", "amazon.titan-embed-text-v1", "", "other"):
        with pytest.raises(ValueError, match="unsupported"):
            adapter_for(model_id)


def test_extension_point(spark, monkeypatch):
    with pytest.raises(TypeError):
        ModelAdapter()
    monkeypatch.setattr(adapters, "_ADAPTERS", list(adapters._ADAPTERS))

    class Echo(MessagesAdapter):
        output_schema = "recordId string, modelOutput struct<said: string>"

        def matches(self, model_id):
            return model_id.startswith("echo")

        def request(self, text, record_id, **_):
            return F.struct(record_id.alias("recordId"), F.struct(text.alias("say")).alias("modelInput"))

        def response(self, parsed):
            return parsed["modelOutput"]["said"]

    register_adapter(Echo())
    assert request(spark, adapter_for("echo-1"))["modelInput"] == {"say": 'say "hi"\né'}


def outcome(spark, adapter, line):
    lines = spark.createDataFrame([(line,)], "value string")
    parsed = parse_lines(lines, adapter.output_schema)
    p = F.col("parsed")
    row = parsed.select(
        p["recordId"], adapter.response(p), F.coalesce("error", adapter.problem(p, F.col("value")))
    ).first()
    return tuple(row)


@pytest.mark.parametrize(
    "output,response,problem",
    [
        ('{"content":[{"type":"text","text":"one"}]}', "one", None),
        ('{"content":[{"text":"a"},{"text":"b"},{"text":"last"}]}', "last", None),
        ('{"content":[{"text":"a"},{"text":null}]}', None, None),
        ('{"content":[{"text":"a"},{"type":"other"}]}', None, "missing text in last content block"),
        ('{"content":[]}', None, "empty content"),
        ('{"stop":1}', None, "missing content"),
        ("null", None, "modelOutput is not an object"),
        ('"text"', None, "modelOutput is not an object"),
        ('{"content":[{"text":"a"},null]}', None, "last content block is not an object"),
        ('{"content":[{"text":"\\u00e9\\ud83d\\ude00 \\"q\\"","extra":{"deep":[1,2]}}]}', 'é😀 "q"', None),
    ],
)
def test_text_output(spark, output, response, problem):
    line = '{"recordId":"r","modelOutput":%s}' % output
    assert outcome(spark, MessagesAdapter(), line) == ("r", response, problem)


def test_text_output_without_model_output_is_a_null_response(spark):
    assert outcome(spark, MessagesAdapter(), '{"recordId":"r","error":{"code":400}}') == ("r", None, None)


def test_missing_record_id(spark):
    assert outcome(spark, MessagesAdapter(), '{"modelOutput":{"content":[{"text":"x"}]}}')[2] == "missing recordId"


@pytest.mark.parametrize(
    "output,problem",
    [
        ('{"embedding":[0.25,-1,1e-3]}', None),
        ("{}", "missing embedding"),
        ('{"embedding":null}', "missing embedding"),
        ('{"embedding":[1,null]}', "embedding holds a value that is not a number"),
    ],
)
def test_embedding_output(spark, output, problem):
    line = '{"recordId":"r","modelOutput":%s}' % output
    _, vector, found = outcome(spark, EmbeddingAdapter(), line)
    assert found == problem
    if problem is None:
        assert vector == [0.25, -1.0, 0.001]


def test_embedding_without_output_is_an_error(spark):
    assert outcome(spark, EmbeddingAdapter(), '{"recordId":"r"}')[2] == "missing embedding"


def test_long_vector_is_exact(spark):
    vector = [((i * 7919) % 1000) / 977 - 0.5 for i in range(1024)]
    line = json.dumps({"recordId": "r", "modelOutput": {"embedding": vector}})
    assert outcome(spark, EmbeddingAdapter(), line)[1] == vector


def test_inline_answers(spark):
    adapter = MessagesAdapter()
    bodies = [
        '{"content":[{"text":"first"},{"text":"second"}],"usage":{"input_tokens":3,"output_tokens":4},"stop_reason":"end"}',
        '{"content":[{"type":"x"}]}',
        "{}",
        '{"content":[]}',
    ]
    lines = spark.createDataFrame([(b,) for b in bodies], "value string").coalesce(1)
    p = F.col("parsed")
    rows = parse_lines(lines, adapter.inline_schema).select(
        adapter.inline_response(p)["response"], adapter.inline_problem(p)
    )
    assert [tuple(r) for r in rows.collect()] == [("first", None), ("", None), ("", None), ("", "empty content")]
