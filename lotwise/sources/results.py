"""Result tables whose chunks are replaced in one step.

Rows lie under ``chunk_idx=N/state=S/results_version=V``. A version is a number that one write uses for all it writes,
and it counts once its commit, a small table under ``_commits``, is complete: until then, and if the write fails,
readers see the rows of before. ``full=V`` replaces the whole table, ``commit=V`` the chunks it names, ``fold=V`` stands
for all commits up to it. There is one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from lotwise.functions.naming import brought_back
from lotwise.session import children, drop_paths, existing, existing_paths, listings, make_folder

VERSION = "results_version"
COMMIT = f"chunk_idx int, {VERSION} int, jobs array<string>, files long"
#: Commits that are folded into one once there are more.
MOST_COMMITS = 64
#: Up to here chunk folders are listed by name, else with all others.
FEW_FOLDERS = 1000


def _numbers(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """The numbers in use, by kind, also of commits that are not complete."""
    found: dict[str, list[int]] = {"full": [], "fold": [], "commit": [], "intent": []}
    for name in children(spark, f"{path}/_commits"):
        kind, _, number = name.partition("=")
        if kind in found:
            found[kind].append(int(number))
    return {kind: sorted(numbers) for kind, numbers in found.items()}


def _live(spark: SparkSession, path: str) -> tuple[int | None, list[str]]:
    """The version of chunks that no commit names, and the folders that tell about the others, oldest first."""
    names = [f"{kind}={n}" for kind, numbers in _numbers(spark, path).items() if kind != "intent" for n in numbers]
    ended = existing_paths(spark, [f"{path}/_commits/{name}/_SUCCESS" for name in names])
    numbers: dict[str, list[int]] = {"full": [], "fold": [], "commit": []}
    for kind, _, number in (done.split("/")[-2].partition("=") for done in ended):
        numbers[kind].append(int(number))
    full = numbers["full"][-1] if numbers["full"] else None
    folds = [n for n in numbers["fold"] if full is None or n > full]
    after = folds[-1] if folds else full
    commits = [n for n in numbers["commit"] if after is None or n > after]
    names = ([f"full={full}"] if full is not None else []) + [f"fold={n}" for n in folds[-1:]]
    return full, [f"{path}/_commits/{n}" for n in names + [f"commit={n}" for n in commits]]


def has_results(spark: SparkSession, path: str) -> bool:
    full, folders = _live(spark, path)
    return bool(folders)


def named_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of each chunk that a commit names, the jobs it was built of and their files (``COMMIT``).

    Reads commits alone: about a row per chunk, no results.
    """
    _, folders = _live(spark, path)
    if not folders:
        return spark.createDataFrame([], COMMIT)
    rows = spark.read.schema(COMMIT).parquet(*folders)
    newest = F.max_by(F.struct(VERSION, "jobs", "files"), VERSION)
    return rows.groupBy("chunk_idx").agg(newest.alias("newest")).select("chunk_idx", "newest.*")


def built_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Jobs whose output is in the results: ``chunk_idx, job_id``."""
    return named_chunks(spark, path).select("chunk_idx", F.explode("jobs").alias("job_id"))


def files_mark(mark: Column | str = "mark") -> Column:
    """One number for the output files of a chunk, from the marks of its files; null where it has none."""
    marks = F.sort_array(F.collect_set(mark))
    return F.when(F.size(marks) > 0, F.xxhash64(marks))


def write_results(
    df: DataFrame,
    path: str,
    chunks: list[int] | None = None,
    built: DataFrame | None = None,
    keep_replaced: bool = False,
) -> None:
    """Write joined results as snappy Parquet under ``chunk_idx=N/state=S``.

    With ``chunks`` only these are replaced, each as a whole: states and rows it had before and has no more are gone.
    A repeated call leaves the same rows. ``built`` names the jobs in them (``chunk_idx, job_id``, and ``mark`` of
    their files).

    Replaced files go after the commit; with ``keep_replaced`` those of the last version stay until their chunk is
    written again, for readers that began before (they must use :func:`read_states`, which leaves them out).
    """
    spark = df.sparkSession
    version = max((n for numbers in _numbers(spark, path).values() for n in numbers), default=-1) + 1
    there = _chunk_folders(spark, path, chunks)
    before = {r[0]: r[1] for r in _of_chunks(named_chunks(spark, path), chunks).collect()} if keep_replaced else {}
    full, _ = _live(spark, path)
    make_folder(spark, f"{path}/_commits/intent={version}")  # the number is taken, also if this write fails
    rows = df.withColumn(VERSION, F.lit(version))
    rows.write.option("compression", "snappy").partitionBy("chunk_idx", "state", VERSION).mode("append").parquet(path)
    commit(spark, path, version, chunks, built)
    _drop_replaced(spark, there, version, before, full if keep_replaced else None)
    intents = _numbers(spark, path)["intent"]
    drop_paths(spark, [f"{path}/_commits/intent={n}" for n in intents if n <= version])
    fold_commits(spark, path)


def commit(
    spark: SparkSession, path: str, version: int, chunks: list[int] | None = None, built: DataFrame | None = None
) -> None:
    """Make a version the current one of the given chunks, or of all: the one step that readers notice."""
    jobs = None
    if built is not None:
        mark = files_mark() if "mark" in built.columns else F.lit(None).cast("long")
        names = F.sort_array(F.collect_set("job_id")).alias("jobs")
        jobs = built.groupBy("chunk_idx").agg(names, mark.alias("files"))
    none = (F.lit(None).cast("array<string>").alias("jobs"), F.lit(None).cast("long").alias("files"))
    if chunks is None:
        rows = spark.createDataFrame([], COMMIT) if jobs is None else jobs
        name = f"full={version}"
    else:
        rows = spark.createDataFrame([(c,) for c in chunks], "chunk_idx int")
        rows = rows.select("chunk_idx", *none) if jobs is None else rows.join(jobs, "chunk_idx", "left")
        name = f"commit={version}"
    rows = rows.select("chunk_idx", F.lit(version).alias(VERSION), "jobs", "files")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/_commits/{name}")


def _of_chunks(rows: DataFrame, chunks: list[int] | None) -> DataFrame:
    return rows if chunks is None else rows.filter(F.col("chunk_idx").isin(chunks))


def _chunk_folders(spark: SparkSession, path: str, chunks: list[int] | None) -> list[str]:
    """The folders of the given chunks, or of all, that are there."""
    if chunks is not None:
        return existing(spark, path, [f"chunk_idx={c}" for c in chunks])
    return [f"{path}/{name}" for name in children(spark, path) if name.startswith("chunk_idx=")]


def _drop_replaced(spark, there, version, before, full) -> None:
    """Delete the files of other versions in chunk folders, but for the version of before where it is given.

    Only folders that were ``there`` before the write can hold any. Spark lists them, by many tasks.
    """
    if not there:
        return
    with listings(spark):
        roots = there if len(there) <= FEW_FOLDERS else sorted({folder.rpartition("/")[0] for folder in there})
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots)
    name = r"/chunk_idx=([^/]*)/(state=[^/]*)/(?:%s=([0-9]+)/)?[^/]*$" % VERSION
    place = [F.regexp_extract("path", name, n).alias(a) for n, a in ((1, "chunk"), (2, "state"), (3, "version"))]
    found: dict[str, dict[str, set[str]]] = {}
    for r in files.select(*place).filter("state <> ''").distinct().collect():
        found.setdefault(r.chunk, {}).setdefault(r.state, set()).add(r.version)
    gone = []
    for folder in there:
        chunk = folder.rpartition("/chunk_idx=")[2]
        kept = {version, before.get(int(chunk), full) if chunk.isdigit() else full}
        left, old = 0, []
        for state, versions in found.get(chunk, {}).items():
            stale = [v for v in versions if v and int(v) not in kept]
            if len(stale) == len(versions - {""}):
                old.append(f"{folder}/{state}")
            else:
                old += [f"{folder}/{state}/{VERSION}={v}" for v in stale]
                left += 1
        gone += old if left else [folder]
    drop_paths(spark, gone)


def fold_commits(spark: SparkSession, path: str, most: int | None = None) -> None:
    """Replace many commits by one table of the chunks that they name; what it covers goes afterwards."""
    _, folders = _live(spark, path)
    commits = [f for f in folders if "/commit=" in f]
    if len(commits) > (MOST_COMMITS if most is None else most):
        last = commits[-1].rpartition("=")[2]
        named_chunks(spark, path).coalesce(1).write.mode("overwrite").parquet(f"{path}/_commits/fold={last}")
        folders = _live(spark, path)[1]
    newest = max((int(f.rpartition("=")[2]) for f in folders), default=-1)
    numbers = _numbers(spark, path)
    named = [(n, f"{path}/_commits/{kind}={n}") for kind in ("full", "fold", "commit") for n in numbers[kind]]
    drop_paths(spark, [folder for n, folder in named if n <= newest and folder not in folders])


def _current(version: Column, full: int | None) -> Column:
    return F.coalesce(version, F.lit(full).cast("int"))


def read_states(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All rows of the current versions, with ``chunk_idx`` and ``state``.

    What is current is fixed here, so later writes change nothing in the table that is returned.
    """
    with listings(spark):
        if schema is None:
            table = spark.read.option("mergeSchema", "true").parquet(path)
        else:
            table = spark.read.schema(StructType(schema.fields).add(VERSION, IntegerType())).parquet(path)
    if VERSION not in table.columns:
        return table
    full, folders = _live(spark, path)
    if not any("/commit=" in f or "/fold=" in f for f in folders):
        return table.filter(F.col(VERSION) == F.lit(full)).drop(VERSION)
    named = named_chunks(spark, path).select("chunk_idx", F.col(VERSION).alias("__current"))
    both = table.join(named, "chunk_idx", "left").filter(F.col(VERSION) == _current(F.col("__current"), full))
    return both.drop(VERSION, "__current").select(*(c for c in table.columns if c != VERSION))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All good chunk results under one prefix as one table."""
    table = read_states(spark, path).filter(F.col("state") == "ok")
    return brought_back(table.drop("state", "output_line"))
