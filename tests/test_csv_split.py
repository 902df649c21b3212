"""CSV files cut at any place give the rows of a scan of the whole file."""

import random

import pytest

from lotwise import prepare
from lotwise.session import settings
from lotwise.sources.csv_split import ends_open, read_split_csv
from lotwise.sources.tables import read_input
from test_runs import spec_of


def whole(spark, path):
    return sorted(map(tuple, spark.read.csv(path, header=True, multiLine=True, escape='"').collect()), key=repr)


def cut(spark, path, size, **options):
    small = {"spark__sql__files__maxPartitionBytes": str(size), "spark__sql__files__openCostInBytes": "0"}
    with settings(spark, **small):
        return read_split_csv(spark, path, **options)


def value(rng):
    plain = ["a", "b c", "", " x ", "1.5", "é😀", "it's", 'in"side', "tab\there"]
    quoted = ["", "a,b", "line\nbreak", 'say ""hi""', "two\n\nbreaks", '""', 'x\n""', "\n", ",\n,", "a\nb\nc\nd", "long " * 9]
    return rng.choice(plain) if rng.random() < 0.6 else f'"{rng.choice(quoted)}"'


def table(seed, rows, end="\n"):
    rng = random.Random(seed)
    lines = ["k,first,second"] + [f"{i},{value(rng)},{value(rng)}" for i in range(rows)]
    if seed % 3 == 0:
        lines.insert(rows // 2, "")
    return "\n".join(lines).replace("\n", end)


def test_states_of_lines():
    for line, before, after in (
        ("a,b", False, False), ('a,"b', False, True), ('"a,b",c', False, False), ('"a""', False, True), ('"a""",x', False, False),
        ('a"b,c', False, False), ('"a"x"y",z', False, False), ("", False, False), ("", True, True), ('b",c', True, False),
        ('b""', True, True), ('b"",c', True, True), ('b"""', True, False), ('x","y', True, True), ('x","y"', True, False), ('"', True, False),
        ('"', False, True), ('"",""', False, False), ("plain, text", True, True),
    ):
        assert ends_open(line, before) == after, (line, before)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_split_offset(spark, tmp_path, end):
    """One file in splits of many sizes, so that cuts fall on every byte."""
    path = str(tmp_path / "t.csv")
    with open(path, "w", newline="") as out:
        out.write(table(1, 6, end))
    want = whole(spark, path)
    assert len(want) == 6
    for size in (1, 2, 5, 11, 16, 41, 1000):
        got = cut(spark, path, size, ordinal="n").collect()
        assert sorted((tuple(r)[:-1] for r in got), key=repr) == want, size
        assert [r.k for r in sorted(got, key=lambda r: r.n)] == [str(i) for i in range(6)]
        assert sorted(r.n for r in got) == list(range(6))


@pytest.mark.parametrize("seed,end,size", [(2, "\n", 40), (3, "\r\n", 64), (6, "\n", 200), (7, "\r\n", 17)])
def test_many_rows(spark, tmp_path, seed, end, size):
    path = str(tmp_path / "t.csv")
    with open(path, "w", newline="") as out:
        out.write(table(seed, 300, end) + (end if seed % 2 else ""))
    found = cut(spark, path, size)
    assert sorted(map(tuple, found.collect()), key=repr) == whole(spark, path)


def test_more_than_one_task_reads_a_file(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as out:
        out.write(table(4, 200))
    from lotwise.sources import csv_split

    seen = []
    real = csv_split.materialize

    def watch(df, name, *more):
        seen.append((name, df.rdd.getNumPartitions() if name != "csv-counts" else 0))
        return real(df, name, *more)

    csv_split.materialize = watch
    try:
        assert cut(spark, path, 500).count() == 200
    finally:
        csv_split.materialize = real
    assert dict(seen)["csv-records"] > 3


def test_several_files_with_headers_in_quotes(spark, tmp_path):
    path = str(tmp_path / "many.csv")
    tmp_path.joinpath("many.csv").mkdir()
    for n, rows in enumerate((3, 0, 40, 1)):
        rng = random.Random(n)
        with open(f"{path}/part-{n}.csv", "w") as out:
            out.write('k,"a\nheader, in quotes",second')
            out.writelines(f"\n{n}-{i},{value(rng)},{value(rng)}" for i in range(rows))
    for size in (9, 30, 10_000):
        got = cut(spark, path, size, ordinal="n")
        assert got.columns == ["k", "a\nheader, in quotes", "second", "n"]
        rows = sorted(map(tuple, got.collect()), key=lambda r: r[-1])
        assert sorted((r[:-1] for r in rows), key=repr) == whole(spark, path)
        assert [r[0] for r in rows] == [f"{n}-{i}" for n, k in enumerate((3, 0, 40, 1)) for i in range(k)]


def test_value_over_many_splits_and_open_end(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    text = "\n".join(["k,v", '1,"' + "long line\n" * 60 + '"', "2,x", '3,"never closed', "4,y"])
    with open(path, "w") as out:
        out.write(text)
    got = sorted(map(tuple, cut(spark, path, 20).collect()), key=repr)
    assert got[:2] == [("1", "long line\n" * 60), ("2", "x")] and got == whole(spark, path)


def test_schema_and_empty_files(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as out:
        out.write("k,v\n1,2.5\n2,\n")
    got = read_input(spark, path, "k int, v double", multi_line="split")
    assert sorted(map(tuple, got.collect())) == [(1, 2.5), (2, None)]
    with open(path, "w") as out:
        out.write("k,v\n")
    assert read_input(spark, path, multi_line="split").count() == 0


@pytest.mark.parametrize("order_by", [[], ["topic"]])
def test_prepare(spark, tmp_path, order_by):
    """A run over a split file numbers rows like one over the whole file."""
    path = str(tmp_path / "topics.csv")
    with open(path, "w") as out:
        out.write("topic,id\n" + "\n".join(f'"t{i:03d}\n{"x" * (i % 7)}",{i}' for i in range(50)))
    rows = {}
    for way in (True, "split"):
        spec = spec_of(tmp_path / str(way), input_uri=path, max_records_per_job=10, max_records_total=33, order_by=order_by, multi_line=way)
        with settings(spark, spark__sql__files__maxPartitionBytes="64", spark__sql__files__openCostInBytes="0"):
            manifest = prepare(spark, spec).orderBy("chunk_idx").collect()
        assert [r.n_records for r in manifest] == [10, 10, 10, 3]
        saved = spark.read.parquet(spec.layout.inputs)
        rows[way] = sorted((r.ordinal, r.topic, r.id) for r in saved.collect())
        assert set(saved.columns) == {"topic", "id", "ordinal", "record_id", "chunk_idx"}
    assert rows[True] == rows["split"]
    with pytest.raises(ValueError):
        spec_of(tmp_path, input_uri=path, multi_line="lines")


def test_large_tables_are_written_as_many_files(spark, tmp_path, monkeypatch):
    """No task writes the whole table: a file holds a bounded part, and each file is read in many splits."""
    from lotwise.plans import queries

    rows = [(i, f'say "{i}",\nnext', "en", i) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "CSV_FILE_BYTES", queries.planned_bytes(spark.read.parquet(f"{tmp_path}/documents.parquet")) // 4)
    written, real = [], queries.write_csv
    monkeypatch.setattr(queries, "write_csv", lambda df, path: (real(df, path), written.append(path)))
    assert sorted(map(tuple, queries.csv_split_scan(spark, str(tmp_path)).collect())) == rows
    assert spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(written[0]).count() == 5
