"""Dense row numbers, chunks and running totals without a single-task window.

Three ways to number rows, chosen by what fixes their order:

* ``number_by_file``   Parquet scan in file order. No shuffle, no extra copy: per-file
  row counts come from footers, the position in the file from ``_metadata.row_index``.
* ``number_by_split``  text or CSV scan in file order. One map-only scratch copy.
* ``number_by_key``    any table in key order. One range shuffle into a scratch copy.

Each reduces to "offset of my block + position in my block"; only the block table
(files, splits or tasks, never rows) is summed up front.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.session import is_map_only, is_whole_scan, materialize, shuffle_bound, sized_shuffles

# Up to here a table of per-block sums is added up by one window task.
SMALL_ROWS = 100_000
# Blocks of a distributed prefix sum.
SUM_BLOCKS = 1_000
# Up to here a row limit is taken with a top-k before numbering.
SMALL_LIMIT = 10_000
# Entries of a broadcast map from blocks to offsets (a hash and a long: some 80 MB); a
# table of more blocks is numbered in groups, each with a map of its own.
MAP_ROWS = 2_000_000

_FILE, _START, _POS, _BLOCK, _OFFSET = "__file", "__start", "__pos", "__block", "__offset"
_TIE, _COPY = "__tie", "__copy"
# monotonically_increasing_id: task number above bit 33, position in the task below.
_TASK_BITS = 33


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _task(pos: Column) -> Column:
    return F.shiftright(pos, _TASK_BITS)


def _in_task(pos: Column) -> Column:
    return pos.bitwiseAND(F.lit((1 << _TASK_BITS) - 1))


def prefix_sum(df: DataFrame, order_by: Sequence[str], value: str, rows: int | None = None, name: str = _OFFSET) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows before this one in ``order_by`` order.

    ``rows`` is a known upper bound on the row count; at most ``SMALL_ROWS`` take one window
    task. More, or an unknown number, are summed within ``SUM_BLOCKS`` ranges first.
    """
    zero = F.lit(0).cast("long")
    if rows is not None and rows <= SMALL_ROWS:  # checked bound: one task holds them easily
        w = Window.orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(F.sum(value).over(w), zero))

    ranged = df.repartitionByRange(SUM_BLOCKS, *order_by).sortWithinPartitions(*order_by)
    staged = materialize(ranged.withColumn("__place", F.monotonically_increasing_id()), "prefix")
    blocked = staged.withColumn("__range", _task(F.col("__place")))
    sums = blocked.groupBy("__range").agg(F.sum(value).alias("__sum"))
    over_blocks = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.select("__range", F.coalesce(F.sum("__sum").over(over_blocks), zero).alias("__base"))
    within = Window.partitionBy("__range").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.join(F.broadcast(blocks), "__range")
        .withColumn(name, F.col("__base") + F.coalesce(F.sum(value).over(within), zero))
        .drop("__range", "__place", "__base")
    )


def with_offsets(rows: DataFrame, offsets: DataFrame, key: Sequence[str], blocks: int) -> DataFrame:
    """Rows with their block's offset, by broadcasts of bounded size: rows are never shuffled for it.

    The map holds a 64-bit hash of each block's key. Where two keys share a hash, the key
    columns themselves are broadcast.
    """
    mark = F.xxhash64(*key)
    hashed = offsets.select(mark.alias("__mark"), *key, F.col(_OFFSET))
    if blocks > 1 and hashed.groupBy("__mark").count().filter("count > 1").isEmpty():
        hashed = hashed.drop(*key)
        same = ["__mark"]
    else:
        same = ["__mark", *key]
    rows = rows.withColumn("__mark", mark)
    groups = max(1, -(-blocks // MAP_ROWS))
    parts = []
    for g in range(groups):
        own = F.pmod("__mark", F.lit(groups)) == g
        one, few = (rows, hashed) if groups == 1 else (rows.filter(own), hashed.filter(own))
        parts.append(one.join(F.broadcast(few), same).drop("__mark"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def number_by_file(scan: DataFrame, limit: int | None = None, name: str = "ordinal") -> DataFrame:
    """Number the rows of an unfiltered Parquet scan in (file path, row) order; map-only.

    With ``limit`` only the files holding the first ``limit`` rows are read.
    """
    files = len(scan.inputFiles())
    columns = [quoted(c) for c in scan.columns]
    # Reads no column: the counts come from the Parquet footers.
    counts = scan.groupBy(F.col("_metadata.file_path").alias(_FILE)).agg(F.count(F.lit(1)).alias("__n"))
    offsets = prefix_sum(counts, [_FILE], "__n", files).drop("__n")
    if limit is not None:
        # Offsets rise with the path, so the last file that is needed prunes all after it.
        last = offsets.filter(F.col(_OFFSET) < limit).agg(F.max(_FILE)).first()[0]
        if last is not None:
            scan = scan.filter(F.col("_metadata.file_path") <= last)
            offsets = offsets.filter(F.col(_FILE) <= last)
    rows = scan.select(
        *columns, F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_POS)
    )
    numbered = with_offsets(rows, offsets, [_FILE], files).select(
        *columns, (F.col(_OFFSET) + F.col(_POS)).alias(name)
    )
    return numbered if limit is None else numbered.filter(F.col(name) < limit)


def number_by_split(
    scan: DataFrame, limit: int | None = None, name: str = "ordinal", scratch: str | None = None
) -> DataFrame:
    """Number the rows of an unfiltered text or CSV scan in (file path, line) order.

    A task reads each of its file splits from start to end, so positions inside a
    split follow the lines whatever the packing of splits into tasks. The scratch
    copy is map-only and pins the split boundaries. With ``limit`` it holds only the
    first files.
    """
    columns = [quoted(c) for c in scan.columns]
    if limit is not None:
        scan = _first_files(scan, limit)
    staged = materialize(
        scan.select(
            *columns,
            F.col("_metadata.file_path").alias(_FILE),
            F.col("_metadata.file_block_start").alias(_START),
            F.monotonically_increasing_id().alias(_POS),
        ),
        "split-numbering",
        scratch,
    )
    blocks = staged.groupBy(_FILE, _START).agg(F.count(F.lit(1)).alias("__n"), F.min(_POS).alias("__first"))
    splits = blocks.count()
    offsets = prefix_sum(blocks, [_FILE, _START], "__n", splits)
    offsets = offsets.select(_FILE, _START, (F.col(_OFFSET) - F.col("__first")).alias(_OFFSET))
    numbered = with_offsets(staged, offsets, [_FILE, _START], splits).select(
        *columns, (F.col(_OFFSET) + F.col(_POS)).alias(name)
    )
    return numbered if limit is None else numbered.filter(F.col(name) < limit)


def _first_files(scan: DataFrame, limit: int) -> DataFrame:
    """The scan cut down to its first files by path that together hold ``limit`` rows.

    Looks at 1, 2, 4, ... files, so it reads at most about twice what is needed.
    """
    # Local paths come as file:///x here and as file:/x in the metadata column.
    files = sorted(re.sub(r"^(\w+):///", r"\1:/", p) for p in scan.inputFiles())
    wanted = 1
    while wanted < len(files):
        first = scan.filter(F.col("_metadata.file_path") <= files[wanted - 1])
        if first.count() >= limit:
            return first
        wanted *= 2
    return scan


def _row_hash(df: DataFrame) -> Column:
    """Hash of the whole row; maps and variants cannot be hashed and go in as JSON."""

    def hashable(f: T.StructField) -> Column:
        odd = "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString()
        return F.to_json(F.struct(quoted(f.name))) if odd else quoted(f.name)

    return F.xxhash64(*[hashable(f) for f in df.schema.fields])


def number_by_key(
    df: DataFrame,
    keys: Sequence[str],
    partitions: int | None = None,
    limit: int | None = None,
    unique: bool = False,
    name: str = "ordinal",
    scratch: str | None = None,
) -> DataFrame:
    """Number rows in the order of ``keys`` with one range shuffle.

    Rows with equal keys keep the file order of a Parquet scan; of other tables they
    follow a hash of the row, and identical rows their position. Either way no two
    rows tie, so one key or one group of copies holding much of the table still
    spreads over many tasks. ``unique=True`` states that ``keys`` have no ties.
    """
    source, columns = df, [quoted(c) for c in df.columns]
    order = [quoted(k) for k in keys]
    if not unique:
        if is_whole_scan(df):
            df = number_by_file(df, name=_TIE)
            order += [F.col(_TIE)]
        else:
            if not is_map_only(df):
                # Row order after a shuffle may change when a task is repeated, and
                # with it the positions below: pin the rows first.
                source = df = materialize(df, "numbering-input")
            df = df.select("*", _row_hash(df).alias(_TIE), F.monotonically_increasing_id().alias(_COPY))
            order += [F.col(_TIE), F.col(_COPY)]

    if limit is not None and limit <= SMALL_LIMIT:
        first = df.orderBy(*order).limit(limit)
        numbered = first.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long") - 1)
        return numbered.select(*columns, name)

    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).select(*columns, F.monotonically_increasing_id().alias(_POS))
    # Whole rows, read once more only: the smaller file is worth its packing.
    with sized_shuffles(df.sparkSession, source, spark__sql__parquet__compression__codec="zstd"):
        staged = materialize(placed, "key-numbering", scratch)

    blocked = staged.withColumn(_BLOCK, _task(F.col(_POS)))
    tasks = partitions or shuffle_bound(df.sparkSession, source)
    counts = blocked.groupBy(_BLOCK).agg(F.count(F.lit(1)).alias("__n"))
    offsets = prefix_sum(counts, [_BLOCK], "__n", tasks).drop("__n")
    numbered = with_offsets(blocked, offsets, [_BLOCK], tasks).select(
        *columns, (F.col(_OFFSET) + _in_task(F.col(_POS))).alias(name)
    )
    return numbered if limit is None else numbered.filter(F.col(name) < limit)


def assign_ordinals(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    partitions: int | None = None,
    limit: int | None = None,
    unique: bool = False,
    text_source: bool = False,
    scratch: str | None = None,
) -> DataFrame:
    """Add ``ordinal`` (0, 1, 2, ...) in key order, or in input order when no keys are given.

    Without keys ``df`` must be a scan as returned by ``read_input``. ``scratch`` names
    the folder of the scratch copy, for callers that delete it afterwards.
    """
    if keys:
        return number_by_key(df, keys, partitions, limit, unique, scratch=scratch)
    return number_by_split(df, limit, scratch=scratch) if text_source else number_by_file(df, limit)


def assign_chunks(df: DataFrame, size: int) -> DataFrame:
    """Add ``chunk_idx``: consecutive runs of ``size`` rows, the last one possibly shorter."""
    if size <= 0:
        raise ValueError("the chunk size must be positive")
    return df.withColumn("chunk_idx", F.expr(f"ordinal div {int(size)}").cast("int"))


def running_total(manifest: DataFrame, block: int = 10_000) -> DataFrame:
    """Add ``rows_before``: records in all earlier chunks.

    Windows run per block of consecutive chunks; one small window adds up the blocks.
    """
    blocked = manifest.withColumn(_BLOCK, F.expr(f"chunk_idx div {int(block)}"))
    zero = F.lit(0).cast("long")
    sums = blocked.groupBy(_BLOCK).agg(F.sum("n_records").alias("__sum"))
    over_blocks = Window.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(_BLOCK, F.coalesce(F.sum("__sum").over(over_blocks), zero).alias("__base"))
    within = Window.partitionBy(_BLOCK).orderBy("chunk_idx").rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.join(bases, _BLOCK)
        .withColumn("rows_before", F.col("__base") + F.coalesce(F.sum("n_records").over(within), zero))
        .drop(_BLOCK, "__base")
    )


def number_lines(lines: DataFrame, keep: Column) -> DataFrame:
    """1-based line numbers of the rows of a text scan for which ``keep`` holds.

    Only block counts and the kept lines leave the map side; blank lines count.
    """
    staged = materialize(
        lines.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias(_START),
            F.monotonically_increasing_id().alias(_POS),
            F.when(keep, F.col("value")).alias("value"),
            F.coalesce(keep, F.lit(False)).alias("__keep"),
        ),
        "line-numbers",
    )
    blocks = staged.groupBy("file_path", _START).agg(F.count(F.lit(1)).alias("__n"), F.min(_POS).alias("__first"))
    # One row per split of one file: bounded by file size over split size.
    w = Window.partitionBy("file_path").orderBy(_START).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn(_OFFSET, F.coalesce(F.sum("__n").over(w), F.lit(0).cast("long")))
    kept = staged.filter("__keep")
    return kept.join(offsets, ["file_path", _START]).select(
        "file_path", (F.col(_OFFSET) + F.col(_POS) - F.col("__first") + 1).alias("line_number"), "value"
    )
