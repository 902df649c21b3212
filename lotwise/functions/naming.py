"""Record ids, job names and per-chunk paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise import fixed


def chunk_label(chunk_idx: Column) -> Column:
    """Chunk number with at least four digits."""
    return F.format_string("%04d", chunk_idx)


def job_name(prefix: str, chunk_idx: Column, run_id: str = "") -> Column:
    """Job name per chunk: shortened prefix, chunk number, six hex digits; same input, same name."""
    token = F.substring(F.sha2(F.concat_ws(":", F.lit(prefix + run_id), chunk_idx.cast("string")), 256), 1, 6)
    suffix = F.concat(F.lit("-part-"), chunk_label(chunk_idx), F.lit("-"), token)
    kept = F.substring(F.lit(prefix), F.lit(1), F.lit(fixed.JOB_NAME_LENGTH) - F.length(suffix))
    return F.regexp_replace(F.concat(kept, suffix), fixed.JOB_NAME_FORBIDDEN, "")


def generated_id(prefix: str, run: str = "") -> Column:
    """Id from prefix, run and row number: a recomputed row gets the same id, a row of another run never does."""
    parts = [F.lit(prefix), *([F.lit(run)] if run else []), F.col("ordinal").cast("string")]
    return F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 32)


def own_column(df: DataFrame, name: str) -> str | None:
    """The column of ``df`` that the session takes for ``name``, in its own spelling."""
    exact = str(df.sparkSession.conf.get("spark.sql.caseSensitive")).lower() == "true"
    return next((c for c in df.columns if c == name or not exact and c.lower() == name.lower()), None)


def with_record_id(df: DataFrame, prefix: str, run: str = "") -> DataFrame:
    """Stamp ``record_id``; an id column of the user's, in any spelling the session accepts, keeps its values."""
    generated = generated_id(prefix, run)
    own = own_column(df, "record_id")
    if own is not None:
        return df.withColumnRenamed(own, "record_id").withColumn(
            "record_id", F.coalesce(F.col("record_id").cast("string"), generated)
        )
    return df.withColumn("record_id", generated)


# Columns that a run adds; input columns of these names are kept under other names until the results are read.
RESERVED = ("ordinal", "chunk_idx", "state", "output_line", "results_version")
_KEPT = "__own_"


def set_aside(df: DataFrame) -> DataFrame:
    """Input columns that are named like columns of the run, under names of their own."""
    clashing = [c for c in (own_column(df, name) for name in RESERVED) if c is not None]
    return df.withColumnsRenamed({c: _KEPT + c for c in clashing})


def brought_back(df: DataFrame) -> DataFrame:
    """Input columns under their own names again, in place of the run's columns of these names."""
    kept = [c for c in df.columns if c.startswith(_KEPT)]
    replaced = [own_column(df, c.removeprefix(_KEPT)) for c in kept]
    return df.drop(*[c for c in replaced if c]).withColumnsRenamed({c: c.removeprefix(_KEPT) for c in kept})


def drop_index_column(df: DataFrame, text_source: bool = True) -> DataFrame:
    """Drop the index column of tables saved with one; in a CSV its header may be blank."""
    names = [fixed.INDEX_COLUMN, *([fixed.BLANK_HEADER] if text_source else [])]
    return df.drop(*[c for c in names if c in df.columns])


def job_id(job_arn: Column) -> Column:
    """Last path segment of a job's full name."""
    return F.substring_index(job_arn, "/", -1)
