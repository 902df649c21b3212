"""A corpus pipeline: quality rules, line dedup, near-dedup, mixing, encoding."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import bpe, line_dedup, mixing, quality, simhash
from lotwise.llm.common import cut, table
from lotwise.session import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and blank texts have no words and go. Repeated rows stay or go alike. An empty table gives an empty one.
    All columns are carried as they are, whatever their names.
    """
    ship_package(spark)
    return quality.kept_documents(docs)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand on many sites; ``n_chars``, where there is one, follows the text.

    Null texts stay null, texts of nothing but such lines become empty. Repeated rows are treated alike. A null source is
    a site of its own. An empty table gives an empty one. All other columns are carried as they are.
    """
    ship_package(spark)
    out = line_dedup.line_dedup(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Null, empty and blank texts are one group. Of repeated rows one stays; null ids stay only where a group has no other.
    An empty table gives an empty one. All columns are carried as they are.
    """
    ship_package(spark)
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice.

    Null and empty texts have size 0 and are drawn at their source's rate. Repeated rows are drawn alike. A null source is
    a source of its own, the last. An empty table gives an empty one. All columns are carried as they are.
    """
    ship_package(spark)
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document with its token count and the digests of its ids and of their decoded text.

    A null text is encoded as an empty one, to no tokens. Repeated rows stay rows. An empty table gives an empty result.
    """
    ship_package(spark)
    return bpe.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_boilerplate),
    ("simhash_near_dedup", keep_one_of_copies),
    ("mix_sources", mix_sources),
    ("bpe", encode_tokens),
]

#: Byte-pair encoding and fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again by the next."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
