import json
import os
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lotwise.operators.reports import estimate_cost, limit_head, preview, sample_success, score_summary
from lotwise.operators.scoring import guarded_caller, input_text_fallback, score_embeddings, score_text, score_to

# Workers cannot import test modules: send the clients below by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def echo_client():
    def answer(body):
        request = json.loads(body)
        prompt = request["messages"][0]["content"]
        if "boom" in prompt:
            raise RuntimeError("throttled")
        if "garbage" in prompt:
            return "{oops"
        if "nothing" in prompt:
            return '{"content":[]}'
        return json.dumps({"content": [{"text": f"{prompt}|{request['max_tokens']}"}], "usage": {"input_tokens": 3, "output_tokens": 1}})

    return answer


def vector_client():
    def answer(body):
        text = json.loads(body)["inputText"]
        if "boom" in text:
            raise RuntimeError("throttled")
        return json.dumps({"embedding": [1.0, len(text)], "inputTextTokenCount": len(text)})

    return answer


def test_errors_stay_in_their_row(spark):
    df = spark.createDataFrame([("a", 1), ("boom", 2), ("garbage", 3), ("nothing", 4), (None, 5)], "t string, k int")
    scored = score_text(df, echo_client, "<{t}>", max_tokens=7)
    assert scored.columns == ["t", "k", "response", "success", "error"]
    rows = {r.k: (r.response, r.success, r.error) for r in scored.collect()}
    assert rows == {
        1: ("<a>|7", True, None),
        2: (None, False, "throttled"),
        3: (None, False, "the answer is not a JSON object"),
        4: (None, False, "empty content"),
    }
    counts = score_summary(scored).first()
    assert tuple(counts) == (4, 1, 3)


def test_missing_fields_can_stop_the_job(spark):
    df = spark.createDataFrame([("a",), (None,)], "t string")
    with pytest.raises(Exception, match="null in template field"):
        score_text(df, echo_client, "{t}", on_missing="fail").collect()
    with pytest.raises(ValueError):
        score_text(df, echo_client, "{t}", on_missing="guess")


def test_embeddings(spark):
    df = spark.createDataFrame([("abc", 1), ("boom", 2), ("", 3), (None, 4)], "input_text string, k int")
    rows = {r.k: (r.embedding, r.token_count, r.success, r.error) for r in score_embeddings(df, vector_client).collect()}
    assert rows == {1: ([1.0, 3.0], 3, True, None), 2: (None, 0, False, "throttled")}


def test_one_call_per_row_and_only_bodies_travel(spark, tmp_path):
    log = str(tmp_path)

    def counting_client():
        import uuid

        inner = echo_client()

        def answer(body):
            open(f"{log}/{uuid.uuid4().hex}", "w").close()
            return inner(body)

        return answer

    df = spark.range(0, 20, 1, 3).select(F.concat(F.lit("t"), "id").alias("t"), F.lit("wide").alias("unused"))
    scored = score_text(df, counting_client, "{t}", with_usage=True)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    written = score_to(scored.filter("success").filter("usage.input_tokens = 3"), f"{tmp_path}/scored.parquet")
    score_summary(written).collect()
    assert written.count() == 20
    assert len([f for f in os.listdir(log) if len(f) == 32]) == 20


def test_retries_with_a_fake_clock():
    waits = []
    tries = iter([RuntimeError("one"), RuntimeError("two"), "ok"])

    def client(_):
        outcome = next(tries)
        if isinstance(outcome, Exception):
            raise outcome
        return outcome

    call = guarded_caller(client, attempts=3, backoff=5, pause=0.1, sleep=waits.append)
    assert call("x") == ("ok", None) and waits == [5, 10, 0.1]

    def failing(_):
        raise RuntimeError("down")

    waits.clear()
    assert guarded_caller(failing, attempts=2, backoff=1, sleep=waits.append)("x") == (None, "down") and waits == [1]


def test_rate_limit_is_shared_between_tasks(spark):
    df = spark.range(0, 20).select(F.col("id").cast("string").alias("t"))
    start = time.time()
    assert len(score_text(df, echo_client, "{t}", requests_per_second=20, max_concurrency=2).collect()) == 20
    assert time.time() - start >= 0.9
    with pytest.raises(ValueError):
        score_text(df, echo_client, "{t}", requests_per_second=0)


def test_fallback_text(spark):
    df = spark.createDataFrame([("a", "b", 1), ("", "b", 2), (None, "", 3), (None, None, None)], "text string, source string, topic int")
    assert [r.input_text for r in input_text_fallback(df.coalesce(1)).collect()] == ["a", "b", "3", ""]
    own = df.withColumn("input_text", F.lit(None).cast("string"))
    assert input_text_fallback(own) is own


def test_reports(spark):
    usage = spark.createDataFrame([("m", 100, 200)] * 100, "model_id string, input_tokens long, output_tokens long")
    prices = spark.createDataFrame([("m", 0.003, 0.015)], "model_id string, usd_per_1k_in double, usd_per_1k_out double")
    assert round(estimate_cost(usage, prices).first().usd, 6) == 0.33
    scored = spark.createDataFrame([(2, "b" * 300, True), (1, "a", False), (3, "c", True)], "k int, response string, success boolean")
    assert sample_success(scored, ["k"]).first().k == 2
    assert [r.k for r in limit_head(scored, ["k"], 2).collect()] == [1, 2]
    assert limit_head(scored, ["k"], 0) is scored
    with pytest.raises(ValueError):
        limit_head(scored, ["k"], -1)
    assert max(len(r.response) for r in preview(scored).collect()) == 200
    vectors = spark.createDataFrame([("t", [1.0, 2.0], 5)], "input_text string, embedding array<double>, token_count long")
    assert tuple(preview(vectors).first()) == ("t", 2, 5)
