import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lotwise.operators import numbering
from lotwise.operators.numbering import (
    assign_chunks,
    assign_ordinals,
    number_by_file,
    number_by_key,
    number_by_split,
    prefix_sum,
    running_total,
)
from lotwise.sources.tables import read_input


@pytest.fixture
def scattered(spark):
    """5,000 rows in no useful order."""
    return spark.range(0, 5000, 1, 7).select(
        F.xxhash64("id").alias("k"), F.col("id"), (F.col("id") % 3).alias("third")
    )


@pytest.mark.parametrize("unique", [True, False])
def test_by_key_equals_a_global_window(spark, scattered, unique):
    w = Window.orderBy("k")
    want = {(r.id, r.n) for r in scattered.select("id", (F.row_number().over(w) - 1).alias("n")).collect()}
    got = {(r.id, r.ordinal) for r in number_by_key(scattered, ["k"], unique=unique).collect()}
    assert got == want


def test_by_key_with_explicit_partitions_and_limit(spark, scattered, monkeypatch):
    want = [r.id for r in scattered.orderBy("k").limit(700).collect()]
    top = number_by_key(scattered, ["k"], limit=700)
    assert [r.id for r in top.orderBy("ordinal").collect()] == want
    monkeypatch.setattr(numbering, "SMALL_LIMIT", 10)
    filtered = number_by_key(scattered, ["k"], partitions=5, limit=700)
    assert [r.id for r in filtered.orderBy("ordinal").collect()] == want


def test_hot_keys_and_copies_spread_over_tasks(spark):
    """A third of the rows are one identical row, the rest share two keys."""
    rows = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "copy").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("v"),
    )
    seen = {}

    original = numbering.materialize

    def spy(df, name, path=None):
        staged = original(df, name, path)
        per_file = staged.groupBy(F.input_file_name()).count().collect()
        seen[name] = max(r["count"] for r in per_file), len(per_file)
        return staged

    numbering.materialize = spy
    try:
        numbered = number_by_key(rows, ["k"], partitions=8).cache()
    finally:
        numbering.materialize = original
    assert numbered.select("ordinal").distinct().count() == 30000
    assert (numbered.agg(F.min("ordinal"), F.max("ordinal")).first()) == (0, 29999)
    largest, files = seen["key-numbering"]
    assert files == 8 and largest < 30000 / 8 * 2
    bounds = numbered.groupBy("k").agg(F.min("ordinal").alias("a"), F.max("ordinal").alias("z")).orderBy("a").collect()
    assert [(r.k, r.a, r.z) for r in bounds] == [("b", 0, 9999), ("c", 10000, 19999), ("copy", 20000, 29999)]


def test_equal_keys_get_the_same_numbers_whatever_the_partitioning(spark, scattered):
    one = number_by_key(scattered.repartition(3), ["third"])
    two = number_by_key(scattered.repartition(11), ["third"], partitions=4)
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in two.collect()}


@pytest.mark.parametrize("limit", [None, 300])
def test_equal_keys_keep_file_order(spark, tmp_path, scattered, limit):
    path = str(tmp_path / "t.parquet")
    scattered.repartitionByRange(5, "id").sortWithinPartitions("id").write.parquet(path)
    scan = read_input(spark, path).select("third", "id")
    w = Window.orderBy("third", "id")
    want = scan.withColumn("n", (F.row_number().over(w) - 1).cast("long")).filter(f"n < {limit or 5000}")
    got = number_by_key(scan, ["third"], limit=limit)
    assert got.columns == ["third", "id", "ordinal"]
    assert {tuple(r) for r in got.collect()} == {(r.third, r.id, r.n) for r in want.collect()}
    filtered = number_by_key(scan.filter("id % 2 = 0"), ["third"])
    assert sorted(r.ordinal for r in filtered.collect()) == list(range(2500))


def test_map_columns_can_be_numbered(spark):
    df = spark.range(20).select(F.lit(1).alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    assert number_by_key(df, ["k"]).select("ordinal").distinct().count() == 20


def test_by_file_follows_files_and_rows(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(0, 1000, 1, 4).repartitionByRange(6, "id").sortWithinPartitions("id").write.option(
        "maxRecordsPerFile", 97
    ).parquet(path)
    scan = read_input(spark, path)
    numbered = number_by_file(scan)
    assert numbered.filter("id <> ordinal").count() == 0 and numbered.count() == 1000
    first = number_by_file(scan, limit=120)
    assert sorted(r.id for r in first.collect()) == list(range(120))
    read = first._jdf.queryExecution().optimizedPlan().toString()
    assert "file_path" in read


def test_by_file_needs_no_shuffle_of_rows(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(0, 1000, 1, 4).write.parquet(path)
    plan = number_by_file(read_input(spark, path))._jdf.queryExecution().executedPlan().toString()
    rows_side = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in rows_side


def test_by_split_follows_lines_over_many_splits(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.mkdir()
    for part in range(3):
        rows = [f"{part * 1000 + i},text {i}" for i in range(1000)]
        (path / f"p{part}.csv").write_text("\n".join(["id,text", *rows]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        scan = spark.read.csv(str(path), header=True)
        numbered = number_by_split(scan)
        assert numbered.filter("cast(id as long) <> ordinal").count() == 0 and numbered.count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
    quoted = assign_ordinals(read_input(spark, str(path)), text_source=True, limit=1500)
    assert sorted(int(r.id) for r in quoted.collect()) == list(range(1500))


@pytest.mark.parametrize("limit,files", [(5, 1), (10, 1), (11, 2), (25, 4), (79, 8), (81, 9), (1000, 9)])
def test_a_limited_text_scan_is_cut_to_its_first_files(spark, tmp_path, limit, files):
    path = tmp_path / "some dir.csv"
    path.mkdir()
    for part in range(9):
        (path / f"p {part}%.csv").write_text("\n".join(["id", *(str(part * 10 + i) for i in range(10))]) + "\n")
    scan = read_input(spark, str(path))
    cut = numbering._first_files(scan, limit)
    assert cut.select("_metadata.file_path").distinct().count() == files
    numbered = number_by_split(scan, limit)
    assert "some%20dir.csv" not in str(numbered.inputFiles())  # reads the scratch copy
    assert sorted(int(r.id) for r in numbered.collect()) == list(range(min(limit, 90)))


def test_csv_with_line_breaks_in_values(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('id,text\n0,"one\ntwo, ""three"""\n1,plain\n')
    rows = number_by_split(read_input(spark, str(path))).orderBy("ordinal").collect()
    assert [(r.id, r.text, r.ordinal) for r in rows] == [("0", 'one\ntwo, "three"', 0), ("1", "plain", 1)]


def test_chunks(spark):
    chunks = assign_chunks(spark.range(25).withColumnRenamed("id", "ordinal"), 10)
    assert sorted(tuple(r) for r in chunks.groupBy("chunk_idx").count().collect()) == [(0, 10), (1, 10), (2, 5)]
    with pytest.raises(ValueError):
        assign_chunks(chunks, 0)


@pytest.mark.parametrize("rows", [None, 300])
def test_prefix_sums(spark, rows):
    df = spark.range(300).select((299 - F.col("id")).alias("pos"), (F.col("id") % 7).alias("v"))
    values = {r.pos: r.v for r in df.collect()}
    got = {r.pos: r.s for r in prefix_sum(df, ["pos"], "v", rows, "s").collect()}
    assert got == {p: sum(values[q] for q in range(p)) for p in range(300)}


def test_running_total_over_blocks(spark):
    df = spark.range(50).select(F.col("id").cast("int").alias("chunk_idx"), (F.col("id") + 1).alias("n_records"))
    got = {r.chunk_idx: r.rows_before for r in running_total(df, block=8).collect()}
    assert got == {c: sum(range(1, c + 1)) for c in range(50)}


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "e.parquet")
    spark.range(0).write.parquet(path)
    assert number_by_file(read_input(spark, path)).count() == 0
    assert number_by_key(read_input(spark, path), ["id"]).count() == 0


def test_many_blocks_take_several_broadcasts_and_no_shuffle_of_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.parquet")
    spark.range(0, 600, 1, 3).repartitionByRange(4, "id").sortWithinPartitions("id").write.option(
        "maxRecordsPerFile", 20
    ).parquet(path)
    monkeypatch.setattr(numbering, "MAP_ROWS", 7)
    monkeypatch.setattr(numbering, "SMALL_ROWS", 3)
    scan = read_input(spark, path)
    numbered = number_by_file(scan)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 4 and "SortMergeJoin" not in plan
    assert numbered.filter("id <> ordinal").count() == 0 and numbered.count() == 600
    assert sorted(r.id for r in number_by_file(scan, limit=130).collect()) == list(range(130))
    keyed = number_by_key(scan, ["id"], partitions=9)
    assert keyed.filter("id <> ordinal").count() == 0 and keyed.count() == 600


def test_very_many_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200000")
    try:
        df = spark.range(40).select((39 - F.col("id")).alias("pos"), F.lit(2).alias("v"))
        got = {r.pos: r.s for r in prefix_sum(df, ["pos"], "v", None, "s").collect()}
        assert got == {p: 2 * p for p in range(40)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_large_limit_stays_spread(spark, monkeypatch):
    """Above the bound of a top-k the first rows come by number, from several tasks, ties and nulls included."""
    from lotwise.operators import numbering, reports

    monkeypatch.setattr(reports, "SMALL_LIMIT", 5)
    monkeypatch.setattr(numbering, "SMALL_LIMIT", 5)
    rows = [(None if i % 9 == 0 else i % 40, i) for i in range(200)]
    frame = spark.createDataFrame(rows, "k int, v int").repartition(4)
    got = reports.limit_head(frame, ["k", "v"], 120)
    assert got.columns == ["k", "v"] and "TakeOrdered" not in got._jdf.queryExecution().executedPlan().toString()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))[:120]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert reports.limit_head(frame, ["k", "v"], 5000).count() == 200
