"""Counts, costs, samples and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise import fixed
from lotwise.operators.numbering import SMALL_LIMIT, number_by_key, quoted


def score_summary(scored: DataFrame) -> DataFrame:
    """Rows processed, successful and failed."""
    ok = F.coalesce(F.col("success"), F.lit(False))
    return scored.agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed")
    )


def records_per_chunk(numbered: DataFrame) -> DataFrame:
    return numbered.groupBy("chunk_idx").agg(F.count(F.lit(1)).alias("n_records"))


def output_paths(manifest: DataFrame) -> DataFrame:
    """Result path of each chunk: a table, as there may be too many chunks for one list."""
    return manifest.select("chunk_idx", "results_path")


def estimate_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Tokens and dollars per model; a model without a price has null dollars.

    Tokens are summed before the price join, so the join sees one row per model.
    """
    totals = usage.groupBy("model_id").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
    )
    dollars = (
        F.col("input_tokens") * F.col("usd_per_1k_in") + F.coalesce(F.col("output_tokens") * F.col("usd_per_1k_out"), F.lit(0.0))
    ) / 1000
    return totals.join(prices, "model_id", "left").select(
        "model_id", "n_records", "input_tokens", "output_tokens", dollars.alias("usd")
    )


def sample_success(scored: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """First successful row."""
    return scored.filter("success").orderBy(*order_by).limit(1)


def limit_head(df: DataFrame, order_by: Sequence[str], n: int = fixed.INLINE_MAX_RECORDS) -> DataFrame:
    """First ``n`` rows; 0 keeps all.

    A few rows are a top-k. More are taken by their number in key order, so that they stay spread over tasks.
    """
    if n < 0:
        raise ValueError("the limit must not be negative")
    if n <= SMALL_LIMIT:
        return df.orderBy(*[quoted(k) for k in order_by]).limit(n) if n else df
    return number_by_key(df, order_by, limit=n, name="__place").drop("__place")


def response_preview(response: Column) -> Column:
    return F.substring(response, 1, fixed.RESPONSE_PREVIEW)


def input_preview(text: Column) -> Column:
    return F.substring(text, 1, fixed.INPUT_PREVIEW)


def preview(scored: DataFrame) -> DataFrame:
    """Short view of scored rows: input and response beginnings, or vector length and token count."""
    columns = scored.columns
    if "embedding" in columns:
        return scored.select(
            input_preview(F.col("input_text")).alias("input"),
            F.size("embedding").alias("dimensions"),
            *([F.col("token_count")] if "token_count" in columns else []),
        )
    shown = next((quoted(c) for c in ("source", "topic") if c in columns), F.lit("N/A"))
    return scored.select(shown.alias("input"), response_preview(F.col("response")).alias("response"))
