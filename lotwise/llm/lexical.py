"""Ranked lexical search, reversed: documents stream through an inverted index over the items' terms."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.bpe import text_parts
from lotwise.llm.common import cut

TOP = 10
#: Items are searched in blocks whose terms have about so many bytes: the most that is broadcast at once.
INDEX_BYTES = 16 << 20
#: Scores that a task holds at once (documents by items).
CELLS = 1 << 20
#: Heaps of an item are merged in so many groups first.
MERGES = 64

#: ASCII characters that end a term become spaces, capitals small letters; all other bytes stay.
_TERMS = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256)).lower()


def term_counts(text: str | None) -> Counter[bytes]:
    """Terms of a whole text with their numbers: letters and digits of ASCII and all beyond, A-Z in lower case."""
    found: Counter[bytes] = Counter()
    for part in text_parts(text or ""):
        found.update(part.translate(_TERMS).split())
    return found


class Index:
    """Which items hold a term: for each term (by its number) a run of item places."""

    def __init__(self, items: list[list[bytes]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        terms = [[self.vocabulary.setdefault(t, len(self.vocabulary)) for t in of_item] for of_item in items]
        term = np.array([t for of_item in terms for t in of_item], np.int64)
        item = np.repeat(np.arange(len(items)), [len(of_item) for of_item in terms])
        order = np.argsort(term, kind="stable")
        self.items = item[order]
        self.starts = np.searchsorted(term[order], np.arange(len(self.vocabulary) + 1))
        self.n_items = len(items)

    def scores(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        """Sums of ``value`` (long) for each of ``rows`` documents and each item, over entries (row, term, value)."""
        width = self.starts[term + 1] - self.starts[term]
        first = np.repeat(self.starts[term] - (np.cumsum(width) - width), width)
        item = self.items[first + np.arange(len(first))]
        total = np.zeros(rows * self.n_items, np.int64)
        np.add.at(total, np.repeat(row, width) * self.n_items + item, np.repeat(value, width))
        return total.reshape(rows, self.n_items)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _counted(index: Broadcast):
    """Each document's length and the numbers and counts of its terms that an item holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value.vocabulary
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column("text"):
                found = term_counts(text.as_py())
                shared = known.keys() & found.keys() if len(known) < len(found) else [t for t in found if t in known]
                sizes.append(found.total())
                terms.append([known[t] for t in shared])
                counts.append([found[t] for t in shared])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    return run


def _best(index: Broadcast, weights: Broadcast, n_docs: int, n_terms: int, top: int):
    """The best documents of this task for each item, kept in a heap of at most ``top``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, weight_of = index.value, weights.value
        heaps: list[list[tuple]] = [[] for _ in range(lookup.n_items)]
        least = np.zeros(lookup.n_items, np.int64)  # a score below it cannot enter the item's heap
        most, step = max(1, CELLS // max(1, lookup.n_items)), 16
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                # Few documents first: their scores soon keep most others out.
                part = batch.slice(at, min(step, most))
                at, step = at + part.num_rows, step * 2
                terms, counts = part.column("terms"), part.column("counts")
                row = np.repeat(np.arange(part.num_rows), np.diff(terms.offsets.to_numpy()))
                term = terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = counts.flatten().to_numpy(zero_copy_only=False)
                n = part.column("n").to_numpy(zero_copy_only=False)
                m = 10 + (90 * n * n_docs) // n_terms
                value = weight_of[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
                scores = lookup.scores(row, term, value, part.num_rows)
                docs = part.column("doc_id").to_pylist()
                for r, i in zip(*(v.tolist() for v in np.nonzero((scores > 0) & (scores >= least)))):
                    # Of equal scores the smaller id is better; a null id comes last.
                    entry = (int(scores[r, i]), docs[r] is not None, -(docs[r] or 0))
                    if len(heaps[i]) < top:
                        heapq.heappush(heaps[i], entry)
                    else:
                        heapq.heappushpop(heaps[i], entry)
                    if len(heaps[i]) == top:
                        least[i] = heaps[i][0][0]
        for i, heap in enumerate(heaps):
            if heap:
                score, known, doc = zip(*heap)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i] * len(heap), pa.int32()),
                        pa.array([-d if k else None for d, k in zip(doc, known)], pa.int64()),
                        pa.array(score, pa.int64()),
                    ],
                    ["place", "doc_id", "score"],
                )

    return run


def _search_block(docs: DataFrame, items: list[tuple], top: int) -> DataFrame:
    """The best documents of the given items: ``place, rank, doc_id, score``."""
    spark: SparkSession = docs.sparkSession
    sc = spark.sparkContext
    index = sc.broadcast(Index([terms for _, terms in items]))
    # Texts are read once: what the items' terms need of them is written.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = rows.mapInArrow(_counted(index), "doc_id long, n long, terms array<int>, counts array<long>")
    counted = cut(counted, "term-counts")
    n_docs, n_terms = counted.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").count()
    weights = np.zeros(len(index.value.vocabulary), np.int64)
    for r in df.collect():  # at most the terms of the block
        weights[r["term"]] = weight(n_docs, r["count"])
    found = counted.filter(F.size("terms") > 0).mapInArrow(
        _best(index, sc.broadcast(weights), n_docs, max(n_terms, 1), top), "place int, doc_id long, score long"
    )
    # Heaps of an item are merged in groups, then the groups, so that no task gets those of all tasks.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = lambda rows, *by: rows.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    ).filter(F.col("rank") <= top)
    merged = ranked(found.withColumn("group", F.spark_partition_id() % MERGES), "place", "group").drop("rank", "group")
    return ranked(merged, "place").select("place", "rank", "doc_id", "score")


def item_blocks(items: DataFrame, most: int = INDEX_BYTES) -> Iterator[list[tuple]]:
    """Distinct items with their distinct terms, ``(item_id, [term, ...])``, in blocks of about ``most`` bytes.

    An item is a row; equal rows are one. A larger item is a block of its own. The blocks come one at a time.
    """
    rows = items.select("item_id", "text").distinct()
    rows = cut(rows.withColumn("at", F.xxhash64("item_id", "text")), "items")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    n, blocks = rows.count(), 1
    while True:
        block = F.pmod(F.col("at"), F.lit(blocks))
        largest = rows.groupBy(block).agg(F.sum(size).alias("bytes")).agg(F.max("bytes")).first()[0] or 0
        if largest <= most or blocks >= n:
            break
        blocks *= 2
    for b in range(blocks):
        found = rows.filter(F.pmod(F.col("at"), F.lit(blocks)) == b).select("item_id", "text").toLocalIterator()
        block, held = [], 0
        for r in found:  # equal hashes aside, a block is within its bound
            terms = sorted(term_counts(r.text))
            if block and held + sum(map(len, terms)) > most:
                yield block
                block, held = [], 0
            held += sum(map(len, terms)) + 64
            if terms:
                block.append((r.item_id, terms))
        if block:
            yield block


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best documents (``doc_id, text``) of each item (``item_id, text``): ``item_id, rank, doc_id, score``.

    An inverted index over the terms of a bounded block of items is broadcast; the term counts of every document stream
    through it and update a heap of ``top`` documents per item in each task; the heaps are merged by rank. Weights and
    lengths are counted over all documents. Larger tables of items are searched in several such passes.

    Null and empty texts, and texts without a term, are no documents to the counts and never found; items without a term
    have no rows. Every row of ``docs`` is a document of its own, also if it repeats; a null doc_id comes after all
    others of its score. Equal rows of ``items`` are one item, other rows with the same id are items of their own under
    that id. Empty tables give an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    out = None
    for block in item_blocks(items):
        names = spark.createDataFrame(
            [(i, item_id) for i, (item_id, _) in enumerate(block)], f"place int, item_id {kind.simpleString()}"
        )
        found = cut(_search_block(docs, block, top).join(F.broadcast(names), "place"), "found-items")
        found = found.select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return out
