"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotwise.llm.common import SPACE, cut, packed

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2.0
SEED = 20_240_601
#: Tables of sources up to this size are broadcast.
BROADCAST_BYTES = 8 << 20


def text_size(text: Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES
) -> DataFrame:
    """Targets of sources: ``source, source_size`` to ``source, source_size, target``.

    Sources are numbered by code point, null last, and take the weights in turn. Together they get ``share`` of all
    sizes by weight, none more than ``most`` times its own size. What a source cannot take is shared again by weight:
    each round only sends two sums to the driver and raises the common price of a unit of weight, so the sources that
    reach their limit only grow in number.
    """
    spark = sizes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = sizes.repartitionByRange(parts, F.col("source").isNull(), F.col("source").asc_nulls_last())
    dealt = cut(dealt.withColumn("part", F.spark_partition_id()), "sources")
    # Two-level numbering: sources may be many, partitions are few.
    before = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = before.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    numbered = dealt.withColumn("place", place).join(F.broadcast(before), "part")
    turn = (F.col("offset") + F.col("place") - 1) % len(weights) + 1
    numbered = cut(
        numbered.select(
            "source",
            "source_size",
            F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")).alias("weight"),
            (F.col("source_size") * F.lit(float(most))).alias("limit"),
        ),
        "source-weights",
    )
    total = numbered.agg(F.sum("source_size")).first()[0] or 0
    price, full = 0.0, -1
    while True:
        at_limit = F.col("limit") <= F.col("weight") * F.lit(price)
        row = numbered.agg(
            F.count(F.when(at_limit, 1)),
            F.sum(F.when(at_limit, F.col("limit"))),
            F.sum(F.when(~at_limit, F.col("weight"))),
        ).first()
        if row[0] == full:
            break
        full = row[0]
        if not row[2]:
            break
        price = (share * total - (row[1] or 0.0)) / row[2]
    return numbered.select(
        "source", "source_size", F.least(F.col("limit"), F.col("weight") * F.lit(price)).alias("target")
    )


def _rated(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds ``copies, source_size, target`` to rows with ``source`` and ``draw``."""
    targets = targets.withColumnRenamed("source", "of_source")
    length, count = targets.agg(F.sum(F.octet_length("of_source")), F.count("*")).first()
    if (length or 0) + 64 * count <= BROADCAST_BYTES:
        targets = F.broadcast(targets)
    # Beyond that size both sides are shuffled; adaptive execution splits a source with a third of all rows.
    both = rows.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    uniform = F.shiftrightunsigned("draw", 11).cast("double") / F.lit(float(1 << 53))
    return both.withColumn("copies", F.floor(rate) + (uniform < rate - F.floor(rate)).cast("long"))


def mix_plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """How often the mix takes each row of ``docs``: ``doc_id, size, source_size, target, copies``.

    A source's rate is its target over its size. A document comes ``floor(rate)`` times, plus once more if a uniform
    number drawn from a hash of its id and text lies below the fraction of the rate, so reruns and repeated tasks agree.

    Null texts have size 0, a null source is a source of its own (the last), a null id draws by its text. Equal rows
    draw alike. A source of size 0 has target and rate 0. An empty table gives an empty plan. Other columns of ``docs``
    are ignored.
    """
    sized = cut(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            text_size(F.col("text")).alias("size"),
            F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw"),
        ),
        "sizes",
    )
    targets = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most
    )
    return _rated(sized, targets).select("doc_id", "size", "source_size", "target", "copies")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the columns of ``docs``.

    Cases as in :func:`mix_plan`. Texts are read twice and multiplied where they are read; they move only if the
    sources are too many to broadcast.
    """
    sizes = docs.groupBy(F.col("source").cast("string").alias("source")).agg(
        F.sum(text_size(F.col("text"))).alias("source_size")
    )
    targets = source_targets(sizes, weights, share, most)
    draw = F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw")
    drawn = packed(docs, F.col("source").cast("string").alias("source"), draw)
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return _rated(drawn, targets).select("row", copies.alias("copy")).select("row.*")
