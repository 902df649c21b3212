"""Model adapters: requests and answers of one model family as Column expressions."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise import fixed


def constant(value: Any) -> Column:
    """A Python value as a literal Column; dicts become structs, lists arrays."""
    if isinstance(value, dict):
        return F.struct(*[constant(v).alias(k) for k, v in value.items()])
    if isinstance(value, list | tuple):
        return F.array(*[constant(v) for v in value])
    return F.lit(value)


class ModelAdapter(ABC):
    """Extension point for a model family.

    Everything works on Columns, so requests and answers stay inside the query plan.
    """

    model_type: str
    result_column: str
    # Schema of one output line, as DDL.
    output_schema: str
    # Schema of one inline answer, as DDL.
    inline_schema: str

    @abstractmethod
    def matches(self, model_id: str | Column) -> Any:
        """Whether the model id belongs here; accepts a string or a Column."""

    @abstractmethod
    def request(self, text: Column, record_id: Column, **options: Any) -> Column:
        """Struct of one request record."""

    @abstractmethod
    def response(self, parsed: Column) -> Column:
        """Result value of one parsed output line."""

    @abstractmethod
    def problem(self, parsed: Column, raw: Column) -> Column:
        """Why an output line is unusable, or null."""

    @abstractmethod
    def inline_request(self, text: Column, **options: Any) -> Column:
        """Struct of one inline call's body."""

    @abstractmethod
    def inline_response(self, parsed: Column) -> dict[str, Column]:
        """Result columns of one parsed inline answer."""

    def inline_problem(self, parsed: Column) -> Column:
        return F.lit(None).cast("string")


class MessagesAdapter(ModelAdapter):
    """Text models that take one user message and answer in content blocks."""

    model_type = "text"
    result_column = "response"
    output_schema = (
        "recordId string, modelOutput struct<content: array<struct<type: string, text: string>>>"
    )
    inline_schema = (
        "content array<struct<type: string, text: string>>, "
        "usage struct<input_tokens: bigint, output_tokens: bigint>, stop_reason string"
    )

    def matches(self, model_id: str | Column) -> Any:
        if isinstance(model_id, str):
            return fixed.TEXT_MODEL_MARK in model_id
        return model_id.contains(fixed.TEXT_MODEL_MARK)

    def request(self, text: Column, record_id: Column, max_tokens: int = fixed.BATCH_MAX_TOKENS, **_: Any) -> Column:
        # Sampling options are accepted and not sent, as batch jobs never carried them.
        block = F.struct(F.lit("text").alias("type"), text.alias("text"))
        message = F.struct(F.lit("user").alias("role"), F.array(block).alias("content"))
        body = F.struct(
            F.lit(fixed.TEXT_API_VERSION).alias("anthropic_version"),
            F.lit(max_tokens).alias("max_tokens"),
            F.array(message).alias("messages"),
        )
        return F.struct(record_id.alias("recordId"), body.alias("modelInput"))

    def response(self, parsed: Column) -> Column:
        return F.try_element_at(parsed["modelOutput"]["content"], F.lit(-1))["text"]

    def problem(self, parsed: Column, raw: Column) -> Column:
        content = parsed["modelOutput"]["content"]
        last = F.try_element_at(content, F.lit(-1))
        # Rare branches, evaluated only where the typed parse left a null.
        has_output = F.array_contains(F.json_object_keys(raw), "modelOutput")
        as_maps = F.from_json(raw, "modelOutput struct<content: array<map<string, string>>>")
        last_keys = F.map_keys(F.try_element_at(as_maps["modelOutput"]["content"], F.lit(-1)))
        return (
            F.when(parsed["recordId"].isNull(), "missing recordId")
            .when(parsed["modelOutput"].isNull() & ~F.coalesce(has_output, F.lit(True)), F.lit(None))
            .when(parsed["modelOutput"].isNull(), "modelOutput is not an object")
            .when(content.isNull(), "missing content")
            .when(F.size(content) == 0, "empty content")
            .when(last.isNull(), "last content block is not an object")
            .when(
                last["text"].isNull() & ~F.coalesce(F.array_contains(last_keys, "text"), F.lit(False)),
                "missing text in last content block",
            )
        )

    def inline_request(
        self,
        text: Column,
        max_tokens: int = fixed.INLINE_MAX_TOKENS,
        temperature: float = fixed.INLINE_TEMPERATURE,
        **_: Any,
    ) -> Column:
        message = F.struct(F.lit("user").alias("role"), text.alias("content"))
        return F.struct(
            F.lit(fixed.TEXT_API_VERSION).alias("anthropic_version"),
            F.array(message).alias("messages"),
            F.lit(max_tokens).alias("max_tokens"),
            F.lit(temperature).alias("temperature"),
        )

    def inline_response(self, parsed: Column) -> dict[str, Column]:
        return {
            "response": F.coalesce(F.get(parsed["content"], F.lit(0))["text"], F.lit("")),
            "usage": parsed["usage"],
            "stop_reason": parsed["stop_reason"],
        }

    def inline_problem(self, parsed: Column) -> Column:
        return F.when(F.size(parsed["content"]) == 0, "empty content")


class EmbeddingAdapter(ModelAdapter):
    """Embedding models that answer with one vector of floats."""

    model_type = "embedding"
    result_column = "embedding"
    output_schema = "recordId string, modelOutput struct<embedding: array<double>>"
    inline_schema = "embedding array<double>, inputTextTokenCount bigint"

    def matches(self, model_id: str | Column) -> Any:
        if isinstance(model_id, str):
            return fixed.EMBEDDING_MODEL_MARK in model_id
        return model_id.contains(fixed.EMBEDDING_MODEL_MARK)

    def request(self, text: Column, record_id: Column, **options: Any) -> Column:
        extra = [constant(v).alias(k) for k, v in options.items()]
        return F.struct(record_id.alias("recordId"), F.struct(text.alias("inputText"), *extra).alias("modelInput"))

    def response(self, parsed: Column) -> Column:
        return parsed["modelOutput"]["embedding"]

    def problem(self, parsed: Column, raw: Column) -> Column:
        vector = parsed["modelOutput"]["embedding"]
        return (
            F.when(parsed["recordId"].isNull(), "missing recordId")
            .when(vector.isNull(), "missing embedding")
            .when(F.exists(vector, lambda x: x.isNull()), "embedding holds a value that is not a number")
        )

    def inline_request(self, text: Column, **options: Any) -> Column:
        return F.struct(text.alias("inputText"), *[constant(v).alias(k) for k, v in options.items()])

    def inline_response(self, parsed: Column) -> dict[str, Column]:
        return {"embedding": parsed["embedding"], "token_count": parsed["inputTextTokenCount"]}


_ADAPTERS: list[ModelAdapter] = [MessagesAdapter(), EmbeddingAdapter()]


def register_adapter(adapter: ModelAdapter) -> None:
    """Add an adapter; the ones registered first are asked first."""
    _ADAPTERS.append(adapter)


def adapter_for(model_id: str) -> ModelAdapter:
    for adapter in _ADAPTERS:
        if adapter.matches(model_id):
            return adapter
    raise ValueError(f"unsupported model_id: {model_id}")


def route_requests(
    model_id: Column, text: Column, record_id: Column, options: Mapping[str, Mapping[str, Any]] | None = None
) -> Column:
    """Request line for a table that names its model in a column; null for unknown models.

    ``options`` are per model type (``{"text": {...}, "embedding": {...}}``): those of one never reach another.
    """
    result = F.lit(None).cast("string")
    for adapter in reversed(_ADAPTERS):
        line = F.to_json(adapter.request(text, record_id, **(options or {}).get(adapter.model_type, {})))
        result = F.when(adapter.matches(model_id), line).otherwise(result)
    return result
