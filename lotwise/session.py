"""Session settings and scratch tables."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "lotwise") -> SparkSession:
    """Session for tests and benchmarks. On a cluster, submit with your own settings instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: Folders that are deleted at the same time.
DROPS_AT_ONCE = 16
#: Up to here children of a folder are asked for by name.
FEW_NAMES = 32
#: Tasks for each core that list the folders of a table.
LISTINGS_PER_CORE = 4

_own_scratch: dict[str, str] = {}
_scope: ContextVar[str | None] = ContextVar("scratch scope", default=None)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for scratch tables: ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder; on a cluster the
    executors would not share it, so that is an error.
    """
    root = _scope.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_scratch:
            _own_scratch[app] = tempfile.mkdtemp(prefix="lotwise-scratch-")
        root = _own_scratch[app]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a scratch table; whatever is there goes when the application ends."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    files, target = _file_system(spark, path)
    files.deleteOnExit(target)
    return path


@contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[None]:
    """Scratch tables made inside are deleted at the end, also after an error."""
    path = scratch_path(spark, name)
    token = _scope.set(path)
    try:
        yield
    finally:
        _scope.reset(token)
        drop_path(spark, path)


def _file_system(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system of a path, and the path in its terms."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table and read it back.

    Cuts the lineage at a table on shared storage, so a lost executor never
    re-evaluates partition-dependent columns or a sampled range partitioning.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    # One file per task keeps "position in task" equal to "position in file".
    df.write.mode("errorifexists").option("maxRecordsPerFile", 0).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table of our own once nothing reads it any more."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete many folders, several at a time."""
    if not paths:
        return
    files, _ = _file_system(spark, paths[0])
    as_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    with ThreadPoolExecutor(DROPS_AT_ONCE) as pool:
        list(pool.map(lambda path: files.delete(as_path(path), True), paths))


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist. The names come in one answer, however many they are."""
    files, target = _file_system(spark, folder)
    if not files.exists(target):
        return []
    found = files.listStatus(target)
    if not len(found):
        return []
    jvm = spark.sparkContext._jvm
    own = found[0].getPath().getParent().toString().rstrip("/") + "/"
    text = jvm.org.apache.commons.lang3.ArrayUtils.toString(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found))
    return sorted(text[1:-1].removeprefix(own).split("," + own))  # no name has a slash


def changed_at(spark: SparkSession, path: str) -> int:
    """When a file was last written, in milliseconds; 0 if it does not exist."""
    files, target = _file_system(spark, path)
    return files.getFileStatus(target).getModificationTime() if files.exists(target) else 0


def make_folder(spark: SparkSession, folder: str) -> None:
    files, target = _file_system(spark, folder)
    files.mkdirs(target)


def existing(spark: SparkSession, folder: str, names: list[str]) -> list[str]:
    """Paths of the named children of a folder that exist: a few are asked for, more are looked up in one listing."""
    if len(names) <= FEW_NAMES:
        return existing_paths(spark, [f"{folder}/{name}" for name in names])
    found = set(children(spark, folder))
    return [f"{folder}/{name}" for name in names if name in found]


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of a few paths that exist."""
    if not paths:
        return []
    files, _ = _file_system(spark, paths[0])
    as_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [path for path in paths if files.exists(as_path(path))]


@contextmanager
def listings(spark: SparkSession) -> Iterator[None]:
    """Open tables of many folders: the tasks that list them follow the cores, not the folders.

    Spark starts a task for each folder otherwise, up to 10,000, and what a task sends to the driver besides its
    listing is more than the listing of one chunk.
    """
    tasks = str(LISTINGS_PER_CORE * spark.sparkContext.defaultParallelism)
    with settings(spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=tasks):
        yield


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that do not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="lotwise-ship-")) / "lotwise.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def planned_bytes(df: DataFrame) -> int:
    """Size of the tables a plan reads, from Spark's statistics; starts no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(s for s in sizes if s < 1 << 60)  # larger means unknown


def _operators(df: DataFrame) -> set[str]:
    found, open_nodes = set(), [df._jdf.queryExecution().optimizedPlan()]
    while open_nodes:
        node = open_nodes.pop()
        found.add(node.getClass().getSimpleName())
        children = node.children()
        open_nodes += [children.apply(i) for i in range(children.size())]
    return found


def is_map_only(df: DataFrame) -> bool:
    """Whether a repeated task gets its rows back in the same order."""
    return _operators(df) <= {"Project", "Filter", "Generate", "LogicalRelation", "Range", "LocalRelation"}


def is_whole_scan(df: DataFrame) -> bool:
    """Whether ``df`` is all rows of a Parquet scan, whatever its columns."""
    if not _operators(df) <= {"Project", "LogicalRelation"}:
        return False
    try:
        df.select("_metadata.row_index")
    except AnalysisException:
        return False
    return True


SHUFFLE_BYTES = 128 << 20
#: Files up to here can be read by one task each.
WHOLE_BYTES = 128 << 20
#: What a scan reckons for opening a file, by Spark's default.
OPEN_BYTES = 4 << 20


def shuffle_bound(spark: SparkSession, *inputs: DataFrame) -> int:
    """Partitions that a shuffle of these tables starts with: one per 128 MB, and no fewer than the setting."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(usual, sum(planned_bytes(df) for df in inputs) // SHUFFLE_BYTES)


def by_chunk(df: DataFrame, *sources: DataFrame, most: int | None = None) -> DataFrame:
    """Rows with each chunk in one task, for a file per chunk.

    The partitions are counted by hand, so AQE does not merge them however few their bytes: a chunk's file takes far
    longer to open than its rows to write. ``sources`` are the tables that the rows come from; ``most`` is a known
    number of chunks.
    """
    tasks = shuffle_bound(df.sparkSession, *(sources or (df,)))
    return df.repartition(tasks if most is None else max(1, min(tasks, most)), "chunk_idx")


@contextmanager
def sized_shuffles(spark: SparkSession, *inputs: DataFrame, **conf: str) -> Iterator[None]:
    """Run an action whose shuffles start with a partition per 128 MB of its inputs.

    A fixed partition count suits one table size only. AQE merges partitions that
    turn out small, but never splits one that starts too large.
    """
    partitions = str(shuffle_bound(spark, *inputs))
    with settings(spark, spark__sql__adaptive__coalescePartitions__initialPartitionNum=partitions, **conf):
        yield


def unsplit(largest: int) -> dict[str, str]:
    """Settings under which a scan reads files of up to ``largest`` bytes (``WHOLE_BYTES`` at most) in one task each."""
    return {
        "spark__sql__files__maxPartitionBytes": str(WHOLE_BYTES),
        "spark__sql__files__openCostInBytes": str(max(OPEN_BYTES, largest)),
    }


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Run an action under temporary SQL settings (dots written as double underscores)."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
