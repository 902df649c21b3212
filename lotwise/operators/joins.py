"""Joining answers back to their inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.naming import own_column
from lotwise.operators.numbering import quoted

# Ids are unique to a chunk, not to a run: equal ids in different chunks never meet.
KEYS = ["chunk_idx", "record_id"]


def suffix_collision(outputs: DataFrame, inputs: DataFrame, result: str) -> tuple[DataFrame, DataFrame, str]:
    """Rename a result column that the input also has: ``_x`` for the model's, ``_y`` for the input's."""
    own = own_column(inputs, result)
    if own is None:
        return outputs, inputs, result
    return (
        outputs.withColumnRenamed(result, f"{result}_x"),
        inputs.withColumnRenamed(own, f"{own}_y"),
        f"{result}_x",
    )


def join_results(outputs: DataFrame, inputs: DataFrame, result: str, how: str = "inner") -> DataFrame:
    """Answers joined to saved inputs on chunk and record id, answer columns first."""
    outputs, inputs, result = suffix_collision(outputs, inputs, result)
    joined = outputs.join(inputs, KEYS, how)
    first = ["record_id", result]
    rest = [c for c in joined.columns if c not in first]
    return joined.select(*[quoted(c) for c in first + rest])


def unmatched(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Keys found on one side only; ``side`` is ``input`` or ``output``. One shuffle of the keys for both directions."""
    left = inputs.select(*KEYS, F.lit(True).alias("__in"))
    right = outputs.select(*KEYS, F.lit(True).alias("__out"))
    return (
        left.join(right, KEYS, "full_outer")
        .filter(F.col("__in").isNull() | F.col("__out").isNull())
        .select(*KEYS, F.when(F.col("__out").isNull(), "input").otherwise("output").alias("side"))
    )


def duplicate_ids(inputs: DataFrame) -> DataFrame:
    """Record ids used more than once inside a chunk; these multiply in the join."""
    return inputs.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
