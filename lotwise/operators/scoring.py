"""Inline scoring: one model call per row, spread over tasks, in waves that are kept."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise import fixed
from lotwise.functions.adapters import EmbeddingAdapter, MessagesAdapter, ModelAdapter
from lotwise.functions.jsonlines import strict_json, stripped
from lotwise.functions.prompts import PromptTemplate, render
from lotwise.operators.calls import CallPolicy, Clock, Pace, call_all
from lotwise.operators.numbering import quoted
from lotwise.session import drop_path
from lotwise.sources.calls import call_keys, finished_calls, pending_calls, write_wave

# Builds a client inside the task: it takes a request body and returns an answer body, both JSON text.
ClientFactory = Callable[[], Callable[[str], str]]
#: Calls of a wave: what a failed run may have to pay for again.
WAVE_CALLS = 100_000


def guarded_caller(
    client: Callable[[str], str],
    attempts: int = 1,
    backoff: float = 5.0,
    pause: float = 0.0,
    sleep: Callable[[float], None] = time.sleep,
) -> Callable[[str], tuple[str | None, str | None]]:
    """Call with retries (waits doubling from ``backoff``), then pause; returns (answer, error)."""

    def call(body: str) -> tuple[str | None, str | None]:
        error = None
        for attempt in range(attempts):
            if attempt:
                sleep(backoff * 2 ** (attempt - 1))
            try:
                answer, error = client(body), None
                break
            except Exception as exc:
                answer, error = None, str(exc)
        if pause:
            sleep(pause)
        return answer, error

    return call


def model_call(body: Column, client_factory: ClientFactory, policy: CallPolicy = CallPolicy()) -> Column:
    """Answer, error and number of tries per request body. Only the body travels to the Python worker, not the row.

    Marked non-deterministic so that the plan keeps a single call per row.
    """
    make_pace, make_clock, call = Pace, Clock, call_all

    @F.pandas_udf("answer string, error string, tries int")
    def call_model(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        client, clock = client_factory(), make_clock()
        pace = make_pace(policy, clock)  # of the whole task: what it learned is kept from batch to batch
        for bodies in batches:
            outcomes = list(call(client, bodies, policy, pace, clock))
            yield pd.DataFrame(outcomes, columns=["answer", "error", "tries"]).astype({"answer": object, "error": object})

    return call_model.asNondeterministic()(body)


def call_policy(
    df: DataFrame,
    requests_per_second: float | None = None,
    max_concurrency: int | None = None,
    attempts: int = 1,
    backoff: float = 5.0,
    in_flight: int = 1,
    **more,
) -> tuple[CallPolicy, int | None]:
    """The policy of one task, and the number of tasks: each has its share of ``requests_per_second``.

    ``max_concurrency`` tasks call at once, each with ``in_flight`` calls.
    """
    rate = None
    if requests_per_second is not None:
        if requests_per_second <= 0:
            raise ValueError("requests_per_second must be positive")
        max_concurrency = max_concurrency or df.sparkSession.sparkContext.defaultParallelism
        rate = requests_per_second / max_concurrency
    return CallPolicy(attempts=attempts, backoff=backoff, rate=rate, in_flight=in_flight, **more), max_concurrency


def answered(df: DataFrame, adapter: ModelAdapter, call: str = "__call", with_tries: bool = False) -> DataFrame:
    """Result columns, ``success`` and ``error`` from the column ``call`` (answer, error, tries), which goes."""
    own = [c for c in df.columns if c != call]
    parsed = df.withColumn("__parsed", strict_json(stripped(F.col(call)["answer"]), adapter.inline_schema))
    problem = (
        F.when(F.col(call)["error"].isNotNull(), F.col(call)["error"])
        .when(F.col("__parsed").isNull(), "the answer is not a JSON object")
        .otherwise(adapter.inline_problem(F.col("__parsed")))
    )
    checked = parsed.withColumn("__problem", problem)
    ok = F.col("__problem").isNull()
    results = [F.when(ok, c).alias(n) for n, c in adapter.inline_response(F.col("__parsed")).items()]
    results += [ok.alias("success"), F.col("__problem").alias("error")]
    if with_tries:
        results.append(F.col(call)["tries"].alias("tries"))
    made = {n.lower() for n in (*adapter.inline_response(F.col("__parsed")), "success", "error")}
    made |= {"tries"} if with_tries else set()
    return checked.select(*(quoted(c) for c in own if c.lower() not in made), *results)


def score(
    df: DataFrame,
    body: Column,
    adapter: ModelAdapter,
    client_factory: ClientFactory,
    log: str | None = None,
    model: str = "",
    wave_calls: int = WAVE_CALLS,
    with_tries: bool = False,
    **policy,
) -> DataFrame:
    """Input columns plus the adapter's result columns, ``success`` and ``error``; a failed row never stops the job.

    Columns of these names from an earlier scoring are replaced. ``policy``: see :func:`call_policy`. ``with_tries``
    adds how often each row's call was made.

    With ``log``, a folder, calls are made now, in waves of about ``wave_calls``, and each wave is kept there once it is
    done. A call is named by a hash of ``model`` and its body: equal requests are one call, and a call that was
    answered, by an earlier run that failed or by one on other rows, is not made again. Calls that failed are.
    """
    if log is not None:
        return _scored_in_waves(df, body, adapter, client_factory, log, model, wave_calls, with_tries, policy)
    policy, tasks = call_policy(df, **policy)
    if tasks:
        df = df.repartition(tasks)
    called = df.withColumn("__call", model_call(F.to_json(body), client_factory, policy))
    return answered(called, adapter, with_tries=with_tries)


def _scored_in_waves(df, body, adapter, client_factory, log, model, wave_calls, with_tries, policy) -> DataFrame:
    spark = df.sparkSession
    policy, tasks = call_policy(df, **policy)
    keyed = df.withColumn("__body", F.to_json(body)).withColumn("__key", call_keys(F.col("__body"), model))
    requests = keyed.select(F.col("__key").alias("call_key"), F.col("__body").alias("body"))
    # The calls of this run, dealt into waves and written: later waves do not read the table again.
    calls, run, waves = pending_calls(requests, log, wave_calls)
    for wave in range(waves):
        some = calls.filter(F.col("wave") == wave)
        some = some.repartition(tasks) if tasks else some
        made = some.select("call_key", model_call(F.col("body"), client_factory, policy).alias("call"))
        write_wave(made.select("call_key", "call.*"), log, run, wave)
    if waves:
        drop_path(spark, f"{log}/calls/run={run}")
    found = finished_calls(spark, log).select(F.col("call_key").alias("__key"), F.col("call").alias("__call"))
    both = keyed.drop("__body").join(found, "__key", "left").drop("__key")
    return answered(both, adapter, with_tries=with_tries)


def score_text(
    df: DataFrame,
    client_factory: ClientFactory,
    template: PromptTemplate | str,
    max_tokens: int = fixed.INLINE_MAX_TOKENS,
    on_missing: str = "skip",
    with_usage: bool = False,
    adapter: ModelAdapter | None = None,
    **options,
) -> DataFrame:
    """Score rows with a text model: adds ``response``, ``success``, ``error``.

    ``on_missing``: ``skip`` leaves out rows with a null template field, ``fail`` stops.
    """
    if on_missing not in ("skip", "fail"):
        raise ValueError("on_missing must be skip or fail")
    adapter = adapter or MessagesAdapter()
    if on_missing == "skip":
        prompt = render(df, template, "drop")
        df = df.withColumn("__prompt", prompt).filter(F.col("__prompt").isNotNull())
    else:
        df = df.withColumn("__prompt", render(df, template, "fail"))
    body = adapter.inline_request(F.col("__prompt"), max_tokens=max_tokens)
    scored = score(df, body, adapter, client_factory, **options).drop("__prompt")
    return scored if with_usage else scored.drop("usage", "stop_reason")


def score_embeddings(
    df: DataFrame, client_factory: ClientFactory, adapter: ModelAdapter | None = None, **options
) -> DataFrame:
    """Score rows with an embedding model: adds ``embedding``, ``token_count``, ``success``, ``error``.

    Rows with empty ``input_text`` are left out; a failed call counts 0 tokens.
    """
    adapter = adapter or EmbeddingAdapter()
    df = df.filter(F.col("input_text") != "")
    scored = score(df, adapter.inline_request(F.col("input_text")), adapter, client_factory, **options)
    return scored.withColumn("token_count", F.when(F.col("success"), F.col("token_count")).otherwise(F.lit(0)))


def score_to(scored: DataFrame, path: str) -> DataFrame:
    """Write scored rows once and return the written table, so that reports repeat no call."""
    scored.write.mode("errorifexists").parquet(path)
    return scored.sparkSession.read.schema(scored.schema).parquet(path)


def input_text_fallback(df: DataFrame) -> DataFrame:
    """Add ``input_text`` from the first non-empty of ``text``, ``source``, ``topic`` where the table has none."""
    if "input_text" in df.columns:
        return df
    candidates = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ("text", "source") if c in df.columns]
    if "topic" in df.columns:
        candidates.append(F.col("topic").cast("string"))
    return df.withColumn("input_text", F.coalesce(*candidates, F.lit("")))
