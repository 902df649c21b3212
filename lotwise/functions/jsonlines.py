"""Strict parsing of JSON lines with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotwise import fixed

# Answers may be long: lift the reader's default limit on one string.
_OPTIONS = {"allowSingleQuotes": "false", "maxStringLen": str(2**31 - 1)}


def stripped(value: Column) -> Column:
    """The line without surrounding whitespace; nearly every line is an object and passes by two byte checks."""
    bare = value.startswith("{") & value.endswith("}")
    return F.when(bare, value).otherwise(F.btrim(value, F.lit(fixed.WHITESPACE)))


def strict_json(line: Column, schema: str) -> Column:
    """The line as a struct, or null unless it is exactly one valid JSON object.

    ``from_json`` stops at the end of the first value, so the line is parsed in two
    wrappings. After that value ``[line]`` accepts only ``]``, or ``,`` and a value;
    ``{"v":line}`` only ``}``, or ``,`` and a key. Nothing but the end of the line
    satisfies both. Bytes that are not UTF-8 make a line bad instead of being replaced.
    """
    listed = F.from_json(F.concat(F.lit("["), line, F.lit("]")), f"array<struct<{_fields(schema)}>>", _OPTIONS)
    keyed = F.from_json(F.concat(F.lit('{"v":'), line, F.lit(',"n":1}')), "n int", _OPTIONS)
    return F.when(F.is_valid_utf8(line) & (keyed["n"] == 1), F.get(listed, F.lit(0)))


def _fields(ddl: str) -> str:
    """``name type, ...`` as the inside of a struct type."""
    return StructType.fromDDL(ddl).simpleString()[len("struct<") : -1]


def parse_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Parse the ``value`` column into ``parsed``; ``error`` says why a line is bad. Blank lines are dropped."""
    return (
        lines.withColumn("value", stripped(F.col("value")))
        .filter(F.col("value") != "")
        .withColumn("parsed", strict_json(F.col("value"), schema))
        .withColumn("error", F.when(F.col("parsed").isNull(), F.lit("not a JSON object")))
    )


def split_good_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without, and bad rows with their ``error``."""
    good = parsed.filter(F.col("error").isNull()).drop("error")
    bad = parsed.filter(F.col("error").isNotNull()).drop("parsed")
    return good, bad
