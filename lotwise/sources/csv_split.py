"""CSV files read by many tasks each, also where values hold line breaks.

A line break inside quotes does not end a record, and whether a line starts inside quotes depends on all lines before
it. A first pass finds, for each split of a file, how it would end and how many records start in it, both for a split
that starts with a record and for one that starts inside quotes. These functions of the splits are combined in file
order, which is a running sum. A second pass then knows how each split starts and puts the lines of its records
together; what crosses into the next split, at most one record a split, is joined afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from lotwise.operators.numbering import prefix_sum, with_offsets
from lotwise.session import materialize, settings

_QUOTED = r'"(?>[^"]*+(?:""[^"]*+)*+)"'
#: A value and what follows it up to the next comma; quotes only count at the start of a value.
_FIELD = rf'(?:{_QUOTED}[^,]*|[^",][^,]*)?'
_CLOSED = re.compile(rf"{_FIELD}(?:,{_FIELD})*", re.DOTALL)
_CLOSING = re.compile(rf'[^"]*+(?:""[^"]*+)*+"[^,]*(?:,{_FIELD})*', re.DOTALL)


def ends_open(line: str, open_: bool) -> bool:
    """Whether a value in quotes goes on after the line, given whether one does before it."""
    return not (_CLOSING if open_ else _CLOSED).fullmatch(line)


_SPLIT = "file string, start long, open_r boolean, n_r long, open_q boolean, n_q long, crlf boolean"


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Consecutive lines of one split."""
    files = batch.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    starts = batch.column("start").to_numpy()
    edges = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
    for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
        if hi > lo:
            yield (batch.column("file")[lo].as_py(), int(starts[lo])), batch.slice(lo, hi - lo)


def _facts(part: pa.RecordBatch) -> tuple[np.ndarray, list[int]]:
    """Which lines are not blank, and the places of lines with a quote."""
    value = part.column("value")
    blank = pc.or_(pc.equal(value, ""), pc.equal(value, "\r"))
    quoted = pc.match_substring(value, '"')
    full = ~blank.to_numpy(zero_copy_only=False).astype(bool)
    return full, np.flatnonzero(quoted.to_numpy(zero_copy_only=False).astype(bool)).tolist()


def _tracked(part: pa.RecordBatch, open_: bool) -> tuple[np.ndarray, bool]:
    """Whether each line starts inside quotes, and whether the next one would."""
    _, marks = _facts(part)
    value = part.column("value")
    inside, at = np.zeros(part.num_rows, bool), 0
    for i in marks:
        inside[at : i + 1] = open_
        open_, at = ends_open(value[i].as_py(), open_), i + 1
    inside[at:] = open_
    return inside, open_


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split: how it ends and how many records start in it, for both ways to start; its kind of line ends."""
    key, now, counts, crlf = None, [False, True], [0, 0], False
    names = ["file", "start", "open_r", "n_r", "open_q", "n_q", "crlf"]

    def row() -> pa.RecordBatch:
        values = [*key, now[0], counts[0], now[1], counts[1], crlf]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names)

    for batch in batches:
        for this, part in _runs(batch):
            if this != key:
                if key is not None:
                    yield row()
                key, now, counts = this, [False, True], [0, 0]
                crlf = part.column("value")[0].as_py().endswith("\r")
            full, _ = _facts(part)
            for way in (0, 1):
                inside, now[way] = _tracked(part, now[way])
                counts[way] += int((full & ~inside).sum())
    if key is not None:
        yield row()


_PIECE = "file string, start long, row long, kind string, text string"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split: ``whole``, ``open`` for one that the split cuts off, ``rest`` for the end of one that
    began before. ``info`` holds the rows before the split, whether its first record is a header (which gets the row
    number -1), its kind of line ends, and whether it starts inside quotes.
    """
    key, held, first = None, [], 0  # lines of the record that is not finished yet
    open_ = crlf = head = False
    at, base = 0, 0
    out: dict[str, list] = {name: [] for name in ("file", "start", "row", "kind", "text")}

    def put(kind: str, lines: list[str]) -> None:
        row = -1 if head and not at else base + at
        for name, value in zip(out, (*key, row, kind, "\n".join(lines))):
            out[name].append(value)

    def batch_of() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        found = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))
        for column in out.values():
            column.clear()
        return found

    def closed() -> None:
        """The held lines are a record that ends here or with the split."""
        nonlocal at
        if held:
            put("rest" if first else "open" if open_ else "whole", held)
            at += 0 if first else 1

    for batch in batches:
        for this, part in _runs(batch):
            if this != key:
                if key is not None:
                    closed()
                key, held = this, []
                info = part.column("info")[0].as_py()
                base, head, crlf, open_ = info >> 3, bool(info & 4), bool(info & 2), bool(info & 1)
                first, at = open_, 0
            inside, after = _tracked(part, open_)
            full, _ = _facts(part)
            for i, line in enumerate(part.column("value").to_pylist()):
                line = line[:-1] if crlf and line.endswith("\r") else line
                if inside[i]:
                    held.append(line)
                    continue
                # The line starts a record, or is blank: what was held is finished.
                open_ = False
                closed()
                held, first = [line] if full[i] else [], False
            open_ = after
            if len(out["text"]) >= 10_000:
                yield batch_of()
    if key is not None:
        closed()
    yield batch_of()


def split_states(splits: DataFrame) -> DataFrame:
    """``file, start, n, open, crlf`` from the functions of the splits: records that start, how the split starts."""
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("open_r") == F.col("open_q")  # ends alike whatever it starts with
    swaps = (F.col("open_r") & ~F.col("open_q")).cast("int")
    counted = splits.withColumn("swaps", F.coalesce(F.sum(swaps).over(before), F.lit(0)))
    last = F.last(F.when(fixed, F.struct("open_r", "swaps")), ignorenulls=True).over(before)
    known = counted.withColumn("last", last)
    since = F.col("swaps") - F.coalesce(F.col("last.swaps"), F.lit(0))
    open_ = F.coalesce(F.col("last.open_r"), F.lit(False)).cast("int").bitwiseXOR((since % 2).cast("int")) == 1
    return known.select(
        "file",
        "start",
        F.when(open_, F.col("n_q")).otherwise(F.col("n_r")).alias("n"),
        open_.alias("open"),
        F.first("crlf").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("crlf"),
    )


def read_split_csv(
    spark: SparkSession, uri: str, schema: StructType | None = None, ordinal: str | None = None
) -> DataFrame:
    """A CSV table (header row, quoted line breaks) read by as many tasks as its size asks for.

    Gives the rows that a scan of whole files gives (``multiLine``), for files whose values are in quotes where they
    hold quotes, commas or line breaks; a quote inside a value without quotes is an ordinary character. Columns are
    strings unless a schema is given. The rows are a scratch copy, so the splits are fixed; files are read twice.
    ``ordinal`` adds the row's number in file order.
    """
    header = spark.read.csv(uri, header=True, multiLine=True, escape='"').schema
    schema = schema or header
    # Both passes must see the same splits, whatever executors there are.
    least = spark.conf.get("spark.sql.files.minPartitionNum", None) or str(spark.sparkContext.defaultParallelism)
    with settings(spark, spark__sql__files__minPartitionNum=least):
        lines = spark.read.text(uri, lineSep="\n").select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        )
        splits = materialize(split_states(lines.mapInArrow(_functions, _SPLIT)), "csv-splits")
        # The header is the first record of a file and has no number.
        first = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        started = F.coalesce(F.sum("n").over(first), F.lit(0))
        heads = ((started == 0) & (F.col("n") > 0)).cast("long")
        counted = materialize(splits.withColumn("rows", F.col("n") - heads).withColumn("head", heads), "csv-counts")
        n = counted.count()
        offsets = prefix_sum(counted, ["file", "start"], "rows", n)
        base = F.col("__offset") - F.col("head")
        flags = F.col("head") * 4 + F.col("crlf").cast("long") * 2 + F.col("open").cast("long")
        offsets = offsets.select("file", "start", (base * 8 + flags).alias("__offset"))
        known = with_offsets(lines, offsets, ["file", "start"], n)
        pieces = known.select("value", "file", "start", F.col("__offset").alias("info")).mapInArrow(_records, _PIECE)
        pieces = materialize(pieces, "csv-records")
    cut_off = pieces.filter("kind <> 'whole'")
    order = Window.partitionBy("file").orderBy("start", F.col("kind") == "open")
    record = F.sum((F.col("kind") == "open").cast("int")).over(order)
    parts = F.array_sort(F.collect_list(F.struct("start", "row", "text"))).alias("parts")
    crossing = cut_off.withColumn("record", record).groupBy("file", "record").agg(parts)
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text")
    records = pieces.filter("kind = 'whole'").select("row", "text")
    records = records.unionByName(crossing.select(F.col("parts")[0]["row"].alias("row"), text)).filter("row >= 0")
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = records.select("row", F.from_csv("text", fields, {"escape": '"'}).alias("fields"))
    return parsed.select("fields.*", *([F.col("row").alias(ordinal)] if ordinal else []))
