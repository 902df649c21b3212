"""Prompt templates: registry, parsing on the driver, rendering as Columns."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.functions.formatting import python_text
from lotwise.operators.numbering import quoted

NULL_POLICIES = ("literal", "empty", "drop", "fail")


@dataclass(frozen=True)
class Segment:
    """Literal text followed by an optional field."""

    literal: str
    field: str | None = None
    conversion: str | None = None
    spec: str = ""


@dataclass(frozen=True)
class PromptTemplate:
    text: str
    segments: tuple[Segment, ...]

    @classmethod
    def parse(cls, text: str) -> PromptTemplate:
        """Parse a Python format string; only plain named fields can be filled from columns."""
        segments = []
        for literal, field, spec, conversion in string.Formatter().parse(text):
            if field is not None:
                if field == "" or field.isdigit():
                    raise ValueError(f"positional field {{{field}}} in template: name a column instead")
                if any(c in field for c in ".[]"):
                    raise ValueError(f"field {{{field}}} in template: attribute and item access are not possible")
                if spec and "{" in spec:
                    raise ValueError(f"field {{{field}}} in template: nested format specs are not possible")
            segments.append(Segment(literal, field, conversion, spec or ""))
        return cls(text, tuple(segments))

    @property
    def fields(self) -> frozenset[str]:
        return frozenset(s.field for s in self.segments if s.field is not None)


# Shipped templates; users register their own.
_PROMPTS: dict[str, str] = {
    "tone_of_text": "Is the mood of this text positive, negative or neutral?\n\n{text}",
    "language_of_text": "Name the language of the following text in English.\n\n{text}",
    "keywords_of_text": "List up to ten keywords of this document, one per line.\n\n{text}",
    "names_for_product": "Suggest three names for this product: {description}",
}


def register_prompt(prompt_id: str, text: str) -> None:
    PromptTemplate.parse(text)
    _PROMPTS[prompt_id] = text


def prompt_ids() -> list[str]:
    return sorted(_PROMPTS)


def resolve_prompt(model_type: str, prompt_id: str | None) -> PromptTemplate | None:
    """Template of a text job; embedding jobs have none."""
    if model_type != "text":
        return None
    if not prompt_id:
        raise ValueError("text models need a prompt_id")
    if prompt_id not in _PROMPTS:
        raise ValueError(f'unknown prompt_id "{prompt_id}"; available: {", ".join(prompt_ids()) or "<none>"}')
    return PromptTemplate.parse(_PROMPTS[prompt_id])


def check_columns(df: DataFrame, required: Sequence[str] | frozenset[str], context: str = "input") -> None:
    """Fail while planning when required columns are missing."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{context} is missing the columns {missing}")


def required_columns(model_type: str, template: PromptTemplate | None) -> frozenset[str]:
    if model_type == "embedding":
        return frozenset({"input_text"})
    return template.fields if template else frozenset()


def render(df: DataFrame, template: PromptTemplate | str, null_policy: str = "literal") -> Column:
    """The filled template for each row of ``df``, as one concatenation.

    Null fields: ``literal`` writes ``None``, ``empty`` writes nothing, ``drop``
    makes the whole prompt null (filter it), ``fail`` stops the query.
    """
    if isinstance(template, str):
        template = PromptTemplate.parse(template)
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    check_columns(df, template.fields, "the table to render")
    types: Mapping[str, T.DataType] = {f.name: f.dataType for f in df.schema.fields}

    def filled(s: Segment) -> Column:
        value = quoted(s.field)
        text = python_text(value, types[s.field], s.conversion, s.spec)
        if null_policy == "literal":
            return F.coalesce(text, F.lit(format("None", s.spec if _text_spec(s.spec) else "")))
        if null_policy == "empty":
            return F.coalesce(text, F.lit(""))
        if null_policy == "fail":
            error = F.raise_error(F.lit(f'null in template field "{s.field}"')).cast("string")
            return F.when(value.isNull(), error).otherwise(text)
        return text

    parts: list[Column] = []
    for s in template.segments:
        if s.literal:
            parts.append(F.lit(s.literal))
        if s.field is not None:
            parts.append(filled(s))
    return F.concat(*parts) if parts else F.lit("")


def _text_spec(spec: str) -> bool:
    try:
        format("None", spec)
    except ValueError:
        return False
    return True


def render_by_id(df: DataFrame, id_column: str, templates: Mapping[str, str], null_policy: str = "literal") -> Column:
    """Prompt per row for a table that names its template in a column; unknown ids give null."""
    result = F.lit(None).cast("string")
    for prompt_id, text in templates.items():
        result = F.when(quoted(id_column) == prompt_id, render(df, text, null_policy)).otherwise(result)
    return result


def unknown_prompt_ids(df: DataFrame, id_column: str, templates: Mapping[str, str]) -> DataFrame:
    """Distinct ids without a template, with their row counts (pre-aggregated before the shuffle)."""
    known = F.coalesce(quoted(id_column).isin(list(templates)), F.lit(False))
    return df.filter(~known).groupBy(quoted(id_column).alias("prompt_id")).agg(F.count(F.lit(1)).alias("n_rows"))
