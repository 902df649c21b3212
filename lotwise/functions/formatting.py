"""Column text as Python's ``format`` writes it."""

from __future__ import annotations

import datetime
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types whose Spark cast to string equals Python's str().
_PLAIN = (T.StringType, T.VarcharType, T.CharType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.ArrayType, T.StructType, T.MapType)


def python_text(value: Column, dtype: T.DataType, conversion: str | None = None, spec: str = "") -> Column:
    """``"{value!conversion:spec}"`` as a Column; null in, null out.

    Strings, integers and booleans stay JVM-side, also with ``!s`` and a bare
    precision on strings; the rest goes through one Arrow-batched worker.
    """
    is_text = isinstance(dtype, T.StringType | T.VarcharType | T.CharType)
    if conversion in (None, "s"):
        if spec == "" or (spec == "s" and (is_text or conversion == "s")):
            if isinstance(dtype, T.BooleanType):
                return F.when(value, F.lit("True")).when(~value, F.lit("False"))
            if isinstance(dtype, _PLAIN):
                return value.cast("string")
            if isinstance(dtype, _NESTED):
                return F.to_json(value)
        precision = re.fullmatch(r"\.(\d+)s?", spec)
        if precision and isinstance(dtype, _PLAIN) and (is_text or conversion == "s"):
            return F.substring(value.cast("string"), 1, int(precision.group(1)))
    if isinstance(dtype, _NESTED):
        raise ValueError(f"a format spec or conversion is not possible on {dtype.simpleString()}")
    return _format_udf(conversion, spec)(value)


def _format_udf(conversion: str | None, spec: str):
    @F.arrow_udf("string")
    def python_format(values: pa.Array) -> pa.Array:
        convert = {"r": repr, "s": str, "a": ascii}.get(conversion, lambda v: v)

        def text(v):
            if v is None:
                return None
            if isinstance(v, datetime.datetime):
                v = v.replace(tzinfo=None)  # already in session time
            return format(convert(v), spec)

        return pa.array([text(v) for v in values.to_pylist()], type=pa.string())

    return python_format
