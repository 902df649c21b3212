"""Input tables: CSV, Parquet and staged datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from lotwise import fixed
from lotwise.session import existing, listings
from lotwise.sources.csv_split import read_split_csv


def input_format(uri: str) -> str:
    """Reader for a path, by its case-sensitive ending."""
    ending = uri.rstrip("/").split(".")[-1]
    if ending not in fixed.INPUT_FORMATS:
        raise ValueError(f"input must end in one of {fixed.INPUT_FORMATS}: {uri}")
    return ending


def read_input(
    spark: SparkSession, uri: str, schema: StructType | str | None = None, multi_line: bool | str = True
) -> DataFrame:
    """Scan a CSV (header row, quoted line breaks) or Parquet table.

    CSV columns are strings unless a schema is given: nothing is inferred, so no
    extra pass is made and values keep their text. With ``multi_line`` one task reads
    a whole CSV file; switch it off where no value holds a line break, so that large
    files are split. ``multi_line="split"`` splits files whose values hold line breaks:
    see ``read_split_csv``.
    """
    kind = input_format(uri)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind == "parquet":
        return reader.parquet(uri)
    if multi_line == "split":
        return read_split_csv(spark, uri, T._parse_datatype_string(schema) if isinstance(schema, str) else schema)
    return reader.csv(uri, header=True, multiLine=multi_line, escape='"')


def dataset_path(root: str, dataset_id: str, split: str = "train") -> str:
    return f"{root.rstrip('/')}/datasets/{dataset_id}/split={split}"


def stage_dataset(df: DataFrame, root: str, dataset_id: str, split: str = "train") -> str:
    """Stage one split of a named dataset as Parquet, replacing an earlier copy of that split."""
    path = dataset_path(root, dataset_id, split)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def read_dataset(spark: SparkSession, root: str, dataset_id: str, split: str = "train") -> DataFrame:
    return spark.read.parquet(dataset_path(root, dataset_id, split))


def read_inputs(spark: SparkSession, path: str, chunks: list[int] | None = None) -> DataFrame:
    """Saved input chunks; ``chunks`` lists and reads only their folders."""
    folders = [path] if chunks is None else existing(spark, path, [f"chunk_idx={c}" for c in chunks])
    with listings(spark):
        if not folders:
            return spark.read.parquet(path).filter(F.lit(False))
        reader = spark.read if chunks is None else spark.read.option("basePath", path)
        return reader.parquet(*folders)
