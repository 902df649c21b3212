"""Chunks replaced in one step: readers before, during and after a write, and after one that failed."""

import os

import pytest
from pyspark.sql import functions as F
from test_runs import answer, ids_by_chunk, put, spec_of, topics

from lotwise import prepare, read_results, run_collect, stream_collect
from lotwise.functions.adapters import adapter_for
from lotwise.sources import results as rs
from lotwise.streaming.collect import due_chunks, due_jobs

LINE = "output_line struct<job_id: string>"


def states(spark, rows):
    return spark.createDataFrame([(c, s, v, (None,)) for c, s, v in rows], f"chunk_idx int, state string, v string, {LINE}")


def seen(table):
    return sorted((r.chunk_idx, r.state, r.v) for r in table.collect())


def jobs(spark, *pairs):
    return spark.createDataFrame(pairs, "chunk_idx int, job_id string")


OLD = [(0, "ok", "a"), (1, "ok", "a"), (1, "rejected", "b"), (2, "ok", "a")]


@pytest.fixture
def path(spark, tmp_path):
    at = str(tmp_path / "results")
    rs.write_results(states(spark, OLD), at)
    return at


def test_chunks_are_replaced_whole(spark, path):
    rs.write_results(states(spark, [(1, "ok", "new")]), path, [1, 2])
    assert seen(rs.read_states(spark, path)) == [(0, "ok", "a"), (1, "ok", "new")]
    # Replaced files are gone, so a plain scan gives the same rows.
    assert seen(spark.read.parquet(path)) == [(0, "ok", "a"), (1, "ok", "new")]
    assert not os.path.exists(f"{path}/chunk_idx=2")
    rs.write_results(states(spark, [(5, "ok", "all")]), path)
    assert seen(rs.read_states(spark, path)) == seen(spark.read.parquet(path)) == [(5, "ok", "all")]
    assert [n for n in os.listdir(f"{path}/_commits") if n != ".DS_Store"] == ["full=2"]


def test_reader_during_a_rewrite(spark, path, monkeypatch):
    """All new files are there, the commit is not: readers of any kind of call see the old rows."""
    during = []
    real = rs.commit

    def look_then_commit(*args):
        assert spark.read.parquet(path).filter("v = 'new'").count() == 2
        during.append(seen(rs.read_states(spark, path)))
        real(*args)

    monkeypatch.setattr(rs, "commit", look_then_commit)
    rs.write_results(states(spark, [(1, "ok", "new"), (7, "ok", "new")]), path, [1, 7])
    assert during == [sorted(OLD)]
    assert seen(rs.read_states(spark, path)) == [(0, "ok", "a"), (1, "ok", "new"), (2, "ok", "a"), (7, "ok", "new")]


def test_reader_that_began_before(spark, path):
    """With the replaced files kept, a table that was opened before gives its rows after two writes of other chunks."""
    before = rs.read_states(spark, path)
    rs.write_results(states(spark, [(1, "ok", "new")]), path, [1], keep_replaced=True)
    middle = rs.read_states(spark, path)
    rs.write_results(states(spark, [(0, "ok", "newer")]), path, [0], keep_replaced=True)
    assert seen(before) == sorted(OLD)
    assert seen(middle) == [(0, "ok", "a"), (1, "ok", "new"), (2, "ok", "a")]
    assert seen(rs.read_states(spark, path)) == [(0, "ok", "newer"), (1, "ok", "new"), (2, "ok", "a")]
    # The next write of a chunk drops what is older than the last version.
    rs.write_results(states(spark, [(1, "ok", "third")]), path, [1], keep_replaced=True)
    assert sorted(os.listdir(f"{path}/chunk_idx=1/state=ok")) == ["results_version=1", "results_version=3"]


@pytest.mark.parametrize("step", ["write", "commit", "delete"])
def test_failed_write(spark, path, monkeypatch, step):
    """A write that fails at any step leaves the old rows, or, after its commit, all new ones."""
    rows = states(spark, [(1, "ok", "new")])
    if step == "write":
        rows = rows.withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    else:
        def fail(*_):
            raise OSError("lost")

        monkeypatch.setattr(rs, "commit" if step == "commit" else "_drop_replaced", fail)
    with pytest.raises(Exception):
        rs.write_results(rows, path, [1])
    monkeypatch.undo()
    new = [(0, "ok", "a"), (1, "ok", "new"), (2, "ok", "a")]
    assert seen(rs.read_states(spark, path)) == (new if step == "delete" else sorted(OLD))
    # The next write is not mixed with what was left over, and clears it away.
    rs.write_results(states(spark, [(1, "ok", "again")]), path, [1])
    want = [(0, "ok", "a"), (1, "ok", "again"), (2, "ok", "a")]
    assert seen(rs.read_states(spark, path)) == seen(spark.read.parquet(path)) == want


def test_commits_are_folded(spark, path, monkeypatch):
    monkeypatch.setattr(rs, "MOST_COMMITS", 3)
    want = {c: v for c, s, v in OLD if s == "ok"}
    for n in range(9):
        rs.write_results(states(spark, [(n % 4, "ok", f"n{n}")]), path, [n % 4], jobs(spark, (n % 4, f"j{n}")))
        want[n % 4] = f"n{n}"
        assert seen(rs.read_states(spark, path)) == sorted([(c, "ok", v) for c, v in want.items()] + ([] if n else [(1, "rejected", "b")]))
    names = sorted(os.listdir(f"{path}/_commits"))
    assert len(names) <= 5 and sum(n.startswith("fold=") for n in names) == 1
    assert {tuple(r) for r in rs.built_jobs(spark, path).collect()} == {(0, "j8"), (1, "j5"), (2, "j6"), (3, "j7")}


def test_empty_results(spark, tmp_path):
    at = str(tmp_path / "none")
    assert not rs.has_results(spark, at) and rs.built_jobs(spark, at).count() == 0
    empty = states(spark, [])
    rs.write_results(empty, at)
    assert rs.has_results(spark, at) and rs.read_states(spark, at, empty.schema).count() == 0
    rs.write_results(states(spark, [(3, "ok", "x")]), at, [3])
    assert seen(rs.read_states(spark, at)) == [(3, "ok", "x")]


def ledger_of(spark, pairs, chunks=True):
    rows = [(f"a/job-{c}", state, None, c if chunks else None) for c, state in pairs]
    return spark.createDataFrame(rows, "job_arn string, status string, error_message string, chunk_idx int")


def test_due_chunks_read_commits_only(spark, tmp_path):
    """Finding the due jobs reads no results, and lists no folder of a finished chunk."""
    spec = spec_of(tmp_path, input_uri=topics(spark, tmp_path, 60), max_records_per_job=10)
    prepare(spark, spec)
    ids, at = ids_by_chunk(spark, spec), spec.layout
    for c in range(5):
        put(spec, c, f"job-{c}", "o", [answer(i, "x") for i in ids[c]])
    done = ledger_of(spark, [(c, "Completed") for c in range(4)])
    assert due_chunks(spark, at.outputs, at.results, done) == [0, 1, 2, 3]
    stream_collect(
        spark, at.outputs, at.inputs, at.results, f"{tmp_path}/state", adapter_for(spec.model_id),
        files_per_batch=2, ledger=lambda s: ledger_of(s, [(c, "Completed") for c in range(4)]),
    ).awaitTermination()
    assert {r.chunk_idx for r in read_results(spark, at.results).collect()} == {0, 1, 2, 3}
    later = ledger_of(spark, [(c, "Completed") for c in range(6)])
    files = due_jobs(spark, at.results, later).inputFiles()
    assert files and all("/_commits/" in f for f in files)
    assert {r.job_id for r in due_jobs(spark, at.results, later).collect()} == {"job-4", "job-5"}
    listed = []
    real = rs.children
    from lotwise.streaming import collect as sc

    def watch(session, folder, chunks, glob):
        listed.append(chunks)
        return real_list(session, folder, chunks, glob)

    real_list = sc.list_outputs
    sc.list_outputs = watch
    try:
        assert due_chunks(spark, at.outputs, at.results, later) == [4]  # chunk 5 has no file yet
        assert due_chunks(spark, at.outputs, at.results, ledger_of(spark, [(4, "Completed")], chunks=False)) == [4]
        assert due_chunks(spark, at.outputs, at.results, done) == []
    finally:
        sc.list_outputs = real_list
    assert listed == [[4, 5], None] and real is rs.children


def test_batch_results_are_not_built_again_by_a_stream(spark, tmp_path):
    spec = spec_of(tmp_path, input_uri=topics(spark, tmp_path), max_records_per_job=10)
    prepare(spark, spec)
    ids = ids_by_chunk(spark, spec)
    for c in range(3):
        put(spec, c, f"job-{c}", "o", [answer(i, "x") for i in ids[c]])
    run_collect(spark, spec)
    ledger = ledger_of(spark, [(c, "Completed") for c in range(3)])
    assert due_chunks(spark, spec.layout.outputs, spec.layout.results, ledger) == []


def test_own_column_named_like_the_version(spark, tmp_path):
    path = str(tmp_path / "own.parquet")
    spark.createDataFrame([("t", "mine")], "topic string, Results_Version string").write.parquet(path)
    spec = spec_of(tmp_path, input_uri=path)
    prepare(spark, spec)
    put(spec, 0, "j", "o", [answer(i, "re") for i in ids_by_chunk(spark, spec)[0]])
    run_collect(spark, spec)
    assert [(r.topic, r.Results_Version, r.response) for r in read_results(spark, spec.layout.results).collect()] == [("t", "mine", "re")]


def test_only_folders_of_before_are_looked_through(spark, tmp_path, monkeypatch):
    """The first write has nothing to replace; a later one deletes in the chunks that it replaces only."""
    gone = []
    real = rs.drop_paths
    monkeypatch.setattr(rs, "drop_paths", lambda s, paths: (gone.extend(p for p in paths if "/chunk_idx=" in p), real(s, paths)))
    listed = []
    folders = rs._chunk_folders
    monkeypatch.setattr(rs, "_chunk_folders", lambda *a: listed.append(folders(*a)) or listed[-1])
    at = str(tmp_path / "results")
    rs.write_results(states(spark, OLD), at)
    assert listed == [[]] and gone == []
    rs.write_results(states(spark, [(1, "ok", "new"), (7, "ok", "new")]), at, [1, 7])
    assert listed[1:] == [[f"{at}/chunk_idx=1"]]
    assert sorted(gone) == [f"{at}/chunk_idx=1/{n}" for n in ("state=ok/results_version=0", "state=rejected")]


def test_names_in_folders(spark, tmp_path, monkeypatch):
    from lotwise import session

    names = ["a,b", "chunk_idx=1", "c d", "é", "{x}"]
    for name in names:
        (tmp_path / "f" / name).mkdir(parents=True)
    at = f"{tmp_path}/f"
    assert session.children(spark, at) == sorted(names) and session.children(spark, f"{at}/c d") == []
    assert session.children(spark, f"{at}/none") == []
    for few in (32, 0):
        monkeypatch.setattr(session, "FEW_NAMES", few)
        assert session.existing(spark, at, ["c d", "none", "a,b"]) == [f"{at}/c d", f"{at}/a,b"]


def test_a_folder_takes_no_task_of_its_own_to_list(spark, tmp_path):
    """Spark lists 400 chunk folders in a few tasks, and a few rows of many chunks are written by more than one."""
    from lotwise.session import LISTINGS_PER_CORE, by_chunk
    from lotwise.sources.tables import read_inputs

    rows = by_chunk(spark.range(400).select((F.col("id") % 400).cast("int").alias("chunk_idx"), "id"))
    at = str(tmp_path / "inputs")
    rows.write.partitionBy("chunk_idx").parquet(at)
    tasks = {n.split("-")[1] for c in os.listdir(at) if c.startswith("chunk_idx=") for n in os.listdir(f"{at}/{c}") if n.startswith("part-")}
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    sc = spark.sparkContext
    sc.setJobGroup("listing", "listing")
    read_inputs(spark, at)
    sc.setJobGroup("other", "other")
    tracker = sc.statusTracker()
    sizes = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert sizes and max(sizes) <= LISTINGS_PER_CORE * sc.defaultParallelism


def test_a_stream_is_opened_in_a_few_listing_tasks(spark, tmp_path):
    from lotwise.session import LISTINGS_PER_CORE
    from lotwise.streaming.collect import read_output_stream, watch_outputs

    lines = spark.range(400).select(F.col("id").cast("string").alias("value"), F.col("id").alias("chunk_idx"))
    at = str(tmp_path / "outputs")
    lines.write.partitionBy("chunk_idx").text(at)
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    for name, opened in (("watch", watch_outputs), ("lines", read_output_stream)):
        sc.setJobGroup(name, name)
        opened(spark, at, glob="part-*")
        sc.setJobGroup("other", "other")
        sizes = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(j).stageIds]
        assert max(sizes, default=0) <= LISTINGS_PER_CORE * sc.defaultParallelism


def test_waiting_chunks_ask_for_the_ledger_once(spark, tmp_path, monkeypatch):
    """However many rebuilds the waiting chunks take, they add one reading of the ledger."""
    from lotwise.streaming import collect as streaming

    spec = spec_of(tmp_path, input_uri=topics(spark, tmp_path, 60), max_records_per_job=10)
    prepare(spark, spec)
    for c, ids in ids_by_chunk(spark, spec).items():
        put(spec, c, f"job-{c}", "o", [answer(i, "x") for i in ids])
    at = spec.layout
    given = []
    real = streaming.output_gate
    monkeypatch.setattr(streaming, "output_gate", lambda s, p, known, *a: given.append(known.inputFiles()) or real(s, p, known, *a))
    monkeypatch.setattr(streaming, "CHUNKS_AT_ONCE", 2)
    done = ledger_of(spark, [(c, "Completed") for c in range(6)])
    stream_collect(
        spark, at.outputs, at.inputs, at.results, str(tmp_path / "state"), adapter_for(spec.model_id),
        files_per_batch=2, ledger=lambda s: done,
    ).awaitTermination()
    assert len(given) == 3 and all("/ledger-" in f for files in given for f in files) and all(given)
    assert read_results(spark, at.results).count() == 60


def test_rerun_query_lists_its_results_in_a_few_tasks(spark, tmp_path, monkeypatch):
    from lotwise.plans import queries
    from lotwise.session import LISTINGS_PER_CORE

    most = LISTINGS_PER_CORE * spark.sparkContext.defaultParallelism
    n = most + 8
    docs = spark.range(n).select(F.col("id").alias("doc_id"), *(F.lit(v).alias(c) for c, v in (("text", "a b"), ("lang", "en"))))
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    labels.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(queries, "SIZE", 1)
    sc = spark.sparkContext
    sc.setJobGroup("rerun", "rerun")
    table = queries.chunk_rerun_turns_bad(spark, str(tmp_path))
    sc.setJobGroup("other", "other")
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("rerun") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) <= most
    rows = table.collect()
    assert len(rows) == n and all(r.good == (r.chunk_idx % 2 == 0) and r.n_rows == 1 for r in rows)
