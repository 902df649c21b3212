"""Writers of a run: inputs, request files, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.operators.numbering import quoted
from lotwise.session import by_chunk, sized_shuffles, unsplit


def write_inputs(df: DataFrame, path: str) -> None:
    """Save the stamped input as snappy Parquet in chunk folders.

    No shuffle: numbered tables hold consecutive rows together, so a task meets
    few chunks and the file count is at most chunks plus scan splits.
    """
    (
        df.sortWithinPartitions("chunk_idx", "ordinal")
        .write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy("chunk_idx")
        .parquet(path)
    )


def write_requests(df: DataFrame, path: str, scattered: list[int] | None = None, largest: int = 0) -> None:
    """Write the request lines (``chunk_idx, ordinal, value``): one uncompressed text file per chunk.

    One file per chunk needs each chunk in one task. ``df`` may come from saved inputs of which all chunks but the
    ``scattered`` ones are a file each, of ``largest`` bytes at most: the scan does not split these files, and only
    the scattered chunks are shuffled. Otherwise all are. Chunks have equal, bounded sizes, so the tasks are even.
    """
    spark, whole = df.sparkSession, {}
    if scattered is None:
        lines = by_chunk(df)
    else:
        apart = F.col("chunk_idx").isin(scattered)
        lines = df.filter(~apart).unionByName(by_chunk(df.filter(apart), most=len(scattered))) if scattered else df
        whole = unsplit(largest)
    lines = lines.sortWithinPartitions("chunk_idx", "ordinal").select("chunk_idx", "value")
    with sized_shuffles(spark, df, **whole):
        (
            lines.write.mode("overwrite")
            .option("compression", "none")
            .option("maxRecordsPerFile", 0)
            .partitionBy("chunk_idx")
            .text(path, lineSep="\n")
        )


def write_rejected(df: DataFrame, path: str) -> None:
    """Save input rows that got no request; usually few, so no folders."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_manifest(manifest: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the manifest as Parquet, or as JSON lines (null fields are left out)."""
    manifest.write.mode("overwrite").format(fmt).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a table as CSV with a header; nested columns as JSON text. White space at the ends of values stays."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    flat = [
        F.to_json(quoted(f.name)).alias(f.name) if isinstance(f.dataType, nested) else quoted(f.name)
        for f in df.schema.fields
    ]
    (
        df.select(*flat)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
