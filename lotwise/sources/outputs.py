"""Model service output: JSON lines under ``outputs/chunk_idx=N/<job id>/``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import fixed
from lotwise.functions.jsonlines import strict_json, stripped
from lotwise.operators.numbering import number_lines
from lotwise.session import existing, listings

LINES = "value string, chunk_idx int, file_path string, job_id string"


def path_job_id(path: Column) -> Column:
    """Job folder of a file; ``_metadata.file_path`` is URL-encoded, a plus sign is not."""
    found = F.regexp_extract(path, r"/chunk_idx=\d+/(?:job_id=)?([^/]+)/", 1)
    return F.when(found.contains("%"), F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))).otherwise(found)


def path_chunk_idx(path: Column) -> Column:
    return F.regexp_extract(path, r"/chunk_idx=(\d+)/", 1).cast("int")


def file_mark() -> Column:
    """A number that tells a scanned file from others and from one that replaced it, by its path, size and time."""
    stamp = F.col("_metadata.file_modification_time").cast("double")
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.file_size"), stamp)


def chunk_folders(spark: SparkSession, path: str, chunks: list[int]) -> list[str]:
    """Existing folders of the given chunks, so that no other folder is listed."""
    return existing(spark, path, [f"chunk_idx={c}" for c in chunks])


def read_outputs(
    spark: SparkSession, path: str, chunks: list[int] | None = None, glob: str = fixed.OUTPUT_FILE_GLOB
) -> DataFrame:
    """Output lines with chunk, job and file; ``chunks`` reads only their folders."""
    folders = [path] if chunks is None else chunk_folders(spark, path, chunks)
    if not folders:
        return spark.createDataFrame([], LINES)
    reader = spark.read.option("pathGlobFilter", glob).option("basePath", path)
    with listings(spark):
        scan = reader.text(folders, lineSep="\n")
    if "chunk_idx" not in scan.columns:
        return spark.createDataFrame([], LINES)
    file_path = F.col("_metadata.file_path")
    return scan.select(
        "value", F.col("chunk_idx").cast("int"), file_path.alias("file_path"), path_job_id(file_path).alias("job_id")
    )


def list_outputs(
    spark: SparkSession, path: str, chunks: list[int] | None = None, glob: str = fixed.OUTPUT_FILE_GLOB
) -> DataFrame:
    """One row per output file; reads names only, never file contents. ``mark`` tells a file from one that replaced it."""
    folders = [path] if chunks is None else chunk_folders(spark, path, chunks)
    if not folders:
        return spark.createDataFrame([], "file_path string, chunk_idx int, job_id string, mark long")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("basePath", path)
    file_path = F.col("_metadata.file_path")  # spelled as for text lines, unlike the path column
    with listings(spark):
        scan = reader.load(folders)
    return scan.select(
        file_path.alias("file_path"),
        path_chunk_idx(file_path).alias("chunk_idx"),
        path_job_id(file_path).alias("job_id"),
        file_mark().alias("mark"),
    )


def first_files(files: DataFrame) -> DataFrame:
    """The first output file of each job by name: the only one that counts."""
    marks = [F.min_by("mark", "file_path").alias("mark")] if "mark" in files.columns else []
    return files.groupBy("chunk_idx", "job_id").agg(F.min("file_path").alias("file_path"), *marks)


def missing_outputs(completed: DataFrame, files: DataFrame) -> DataFrame:
    """Completed jobs without any output file."""
    return completed.join(files.select("job_id").distinct(), "job_id", "left_anti")


def locate_bad_lines(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """File, 1-based line number and text of every line that does not parse.

    Meant for the files an earlier run found bad: it reads those again.
    """
    line = stripped(F.col("value"))
    bad = (line != "") & strict_json(line, schema).isNull()
    return number_lines(spark.read.text(paths, lineSep="\n"), bad)
