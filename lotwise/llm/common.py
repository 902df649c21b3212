"""What the operators share: words, tables, scratch copies, bounded blocks of text."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.session import materialize, scratch_path

#: A word is a longest run of characters other than these (``bytes.split`` cuts at the same ones).
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+"), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas use it."""
    return F.transform(F.array(value), body)[0]


def packed(docs: DataFrame, *columns: Column) -> DataFrame:
    """``docs`` as one column ``row`` beside ``columns``: its names, whatever they are, meet no other.

    ``select("row.*")`` gives its columns back.
    """
    return docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"), *columns)


def quoted(name: str) -> str:
    """A column's name as a reference to it, also with dots or backticks in it."""
    return "`" + name.replace("`", "``") + "`"


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def application_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir`` that goes when the application ends."""
    path = scratch_path(spark, f"llm-{name}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back, so that nothing recomputes it."""
    return materialize(df, name, application_path(df.sparkSession, name))


def blocks(rows: Iterable[tuple], size: Callable[[tuple], int], most: int) -> Iterator[list[tuple]]:
    """Consecutive rows in lists of about ``most`` bytes; a larger row comes alone."""
    block: list[tuple] = []
    held = 0
    for row in rows:
        n = size(row)
        if block and held + n > most:
            yield block
            block, held = [], 0
        block.append(row)
        held += n
    if block:
        yield block
