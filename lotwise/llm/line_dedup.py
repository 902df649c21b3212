"""Line dedup by the spread of lines over sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import SPACE, cut, let, packed, quoted

MIN_SITES = 10
#: Sketches have 2^12 registers: their relative error is 1.6 percent, so an estimate outside this share is decisive.
LOG_REGISTERS = 12
NEAR = 0.1
#: Tables of line hashes up to so many rows are broadcast.
BROADCAST_ROWS = 200_000

_EDGE = " \t\n\x0b\x0c\r"


def _line(text: Column) -> Column:
    return F.btrim(text, F.lit(_EDGE))


def _lines(docs: DataFrame, *keep: Column | str) -> DataFrame:
    """A row per line with a word: ``keep``, its place, and the hash of the line without white space at its ends."""
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    rows = docs.select(*keep, F.posexplode(lines).alias("place", "line"))
    rows = rows.filter(F.col("line").rlike(f"[^{SPACE}]"))
    return rows.withColumn("line_hash", F.xxhash64(_line(F.col("line")))).drop("line")


def _sized(table: DataFrame) -> DataFrame:
    """Broadcast a written table of hashes if it is small; else joins shuffle it, and hot lines are split at run time."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def spread_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """Lines that stand on ``min_sites`` distinct sites or more: ``line_hash, home``, the smallest doc_id with the line.

    Each line hash has a HyperLogLog sketch of its sites, built before the shuffle and merged after it. Estimates far
    from the threshold decide; lines near it are counted exactly in a second pass over these alone.
    """
    where = F.coalesce(F.concat(F.lit("s"), F.col(quoted(site)).cast("string")), F.lit("none")).alias("site")
    lines = _lines(docs, F.col("doc_id").cast("long").alias("doc_id"), where)
    sketched = lines.groupBy("line_hash").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", LOG_REGISTERS)).alias("sites"), F.min("doc_id").alias("home")
    )
    # At least one site either way, as small counts are rounded.
    low, high = min(min_sites * (1 - NEAR), min_sites - 1), max(min_sites * (1 + NEAR), min_sites + 1)
    found = cut(sketched.filter(F.col("sites") >= low), "line-spread")
    near = cut(found.filter(F.col("sites") <= high).select("line_hash"), "near-lines")
    exact = (
        lines.join(_sized(near), "line_hash", "left_semi")
        .select("line_hash", "site")
        .distinct()
        .groupBy("line_hash")
        .count()
        .filter(F.col("count") >= min_sites)
        .select("line_hash")
    )
    sure = found.filter(F.col("sites") > high).select("line_hash")
    return found.join(sure.union(exact), "line_hash", "left_semi").select("line_hash", "home")


def _without(text: Column, gone: Column) -> Column:
    """A text without the lines at the places ``gone``; as it is where that is null."""

    def rest(lines: Column) -> Column:
        # A difference of arrays works by hash, so a long text with many lines to drop is no product of the two.
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    return F.when(gone.isNull(), text).otherwise(let(F.split(text, "\n", -1), rest))


def line_dedup(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` without boilerplate: a line on ``min_sites`` sites or more stays only in its home documents.

    Lines are the parts of a text between newlines that hold a word, compared without white space at their ends by
    XXH64. Home is the smallest doc_id that has the line, so no content is lost; every row with that id keeps it.
    Documents stay rows, also when nothing is left of them.

    A null text stays null and has no lines; an empty one stays empty. A null site is one site of its own. Null ids
    count as the largest: they are home only to lines that no other row has. Repeated rows are treated alike. An empty
    table gives an empty one. All columns are carried and only ``text`` changes.
    """
    spread = _sized(cut(spread_lines(docs, site, min_sites), "boilerplate"))
    id_, hash_ = F.col("doc_id").cast("long"), F.xxhash64("text")
    away = _lines(docs, id_.alias("id"), hash_.alias("hash")).join(spread, "line_hash")
    away = away.filter(~F.col("home").eqNullSafe(F.col("id")))
    marks = away.groupBy(F.col("id").alias("mark_id"), F.col("hash").alias("mark_hash"))
    marks = marks.agg(F.collect_set("place").alias("gone"))
    rows = packed(docs, id_.alias("id"), hash_.alias("hash"))
    both = rows.join(marks, F.col("id").eqNullSafe(F.col("mark_id")) & (F.col("hash") == F.col("mark_hash")), "left")
    of_row = lambda c: F.col("row").getField(c)
    text = _without(of_row("text"), F.col("gone"))
    return both.select(*((text if c == "text" else of_row(c)).alias(c) for c in docs.columns))
