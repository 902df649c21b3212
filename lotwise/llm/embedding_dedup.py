"""Embedding near-dedup by product quantisation: inverted lists, residual codes, table-lookup distances, exact cosine."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import cut
from lotwise.llm.components import Forest, components

COSINE = 0.9
#: An index is fitted on at most so many vectors, and so many bytes: those whose hashes are smallest.
SAMPLE_ROWS = 1 << 14
SAMPLE_BYTES = 64 << 20
#: Vector lengths with an index of their own: the most frequent ones. Others have a single list without codes.
LENGTHS = 32
MAX_LISTS = 1 << 12
ROUNDS = 8
#: Lists are made fewer, down to MEMBERS vectors each, while a vector visits more than so many on average.
VISITS = 16
MEMBERS = 4096
#: A code has a byte for every so many dimensions, which names one of the words of that subspace.
SUBSPACE = 4
WORDS = 256
BOOK_ROWS, BOOK_ROUNDS = 1 << 13, 5
#: Distances that are held at once.
DISTANCES = 1 << 20
#: Bytes of vectors (in double precision) and of codes on either side of a task.
VECTOR_BYTES = 4 << 20
CODE_BYTES = 16 << 20
#: Queries whose tables, and codes whose sums, are held at once; candidate pairs that are checked at once.
QUERIES = 128
CODES = 2048
PAIRS = 1 << 17
#: Table entries are whole numbers of this part of one, in 16 bits: sums stay below 4 as they are products of vectors.
STEP = 2.0**-13
SEED = 7


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0.0)


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    step = max(1, DISTANCES // len(centres))
    parts = [_square_distances(points[at : at + step], centres).argmin(1) for at in range(0, len(points), step)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _centres(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = ROUNDS) -> np.ndarray:
    """k-means; a centre that loses all points stays where it is."""
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _nearest(points, centres)
        count = np.bincount(nearest, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, nearest, points)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


@dataclass(frozen=True)
class Index:
    """Centres of the lists, words of each subspace, and the largest distance of unit vectors that link.

    A vector's own list is the nearest. Its code names, for each subspace, the word nearest to its offset from the
    centre of that list.
    """

    lists: np.ndarray
    books: np.ndarray  # subspace, word, dimension
    reach: float

    @classmethod
    def plain(cls, size: int, cosine: float) -> Index:
        """One list around the origin and empty codes."""
        reach = math.sqrt(max(0.0, 2 - 2 * cosine))
        return cls(np.zeros((1, size)), np.empty((0, WORDS, SUBSPACE), np.float32), reach)

    @classmethod
    def fit(cls, sample: np.ndarray, rows: int, cosine: float) -> Index:
        """``sample``: unit vectors; ``rows``: vectors to be indexed. Lists grow with the square root of the rows.

        The sample sets the cost alone: with any centres and words every link is found. Where vectors without structure
        would visit most lists, there are only as many as blocks of members.
        """
        plain = cls.plain(sample.shape[1], cosine)
        most = min(MAX_LISTS, len(sample) // 4 or 1)
        least = min(most, 1 << max(0, math.ceil(math.log2(rows / MEMBERS))))
        k = max(least, min(most, 1 << round(math.log2(math.sqrt(rows)))))
        while True:
            index = cls(_centres(sample, k, np.random.default_rng(SEED)), plain.books, plain.reach)
            if k <= least or sum(len(found) - 1 for found in index.visits(sample)) <= VISITS * len(sample):
                break
            k = max(least, k // 2)
        some = sample[:BOOK_ROWS]
        offsets = index._parts(some - index.lists[_nearest(some, index.lists)])
        rng = np.random.default_rng(SEED)
        books = np.zeros((offsets.shape[1], WORDS, SUBSPACE))
        for s in range(offsets.shape[1]):
            words = _centres(offsets[:, s], WORDS, rng, BOOK_ROUNDS)
            books[s, : len(words)] = words
        return cls(index.lists, books.astype(np.float32), index.reach)

    @staticmethod
    def _parts(vectors: np.ndarray) -> np.ndarray:
        """Vectors by subspace, the last one filled with zeros."""
        n, size = vectors.shape
        full = -(-size // SUBSPACE) * SUBSPACE
        return np.pad(vectors, ((0, 0), (0, full - size))).reshape(n, -1, SUBSPACE)

    def visits(self, unit: np.ndarray) -> Iterator[np.ndarray]:
        """Per vector its own list, then each list that it visits.

        A vector within ``reach`` that is in another list lies on that list's side of the plane halfway between the two
        centres, so the plane is within ``reach`` of this vector, and the other way round: only lists beyond a plane
        further off are left out. Of the two lists of a pair one visits the other, by turns.
        """
        every, step = np.arange(len(self.lists)), max(1, DISTANCES // len(self.lists))
        for at in range(0, len(unit), step):
            far = _square_distances(unit[at : at + step], self.lists)
            own = far.argmin(1)
            homes, of = np.unique(own, return_inverse=True)
            apart = np.sqrt(_square_distances(self.lists[homes], self.lists))[of]
            near = far - far.min(1)[:, None] <= 2 * self.reach * apart + 1e-6
            home = own[:, None]
            near &= (home != every) & ((home < every) == ((home + every) % 2 == 1))
            for h, row in zip(own.tolist(), near):
                yield np.concatenate([[h], np.flatnonzero(row)]).astype(np.int32)

    def coded(self, unit: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of vectors, a byte for each subspace, and how far each vector is from what its code stands for."""
        offset = unit - self.lists[home]
        codes = np.zeros((len(unit), len(self.books)), np.uint8)
        if not len(self.books):
            return codes, np.sqrt((offset * offset).sum(1))
        parts = self._parts(offset)
        left = np.zeros(len(unit))
        for s, book in enumerate(self.books.astype(np.float64)):
            codes[:, s] = _nearest(parts[:, s], book)
            rest = parts[:, s] - book[codes[:, s]]
            left += (rest * rest).sum(1)
        return codes, np.sqrt(left)

    def tables(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Products of queries with the centres (list by query) and with all words (subspace, word, query), in steps."""
        parts = self._parts(queries)[:, : len(self.books)].astype(np.float32)
        words = np.einsum("swd,qsd->swq", self.books, parts)
        return tuple(np.rint(table / STEP).astype(np.int16) for table in (self.lists @ queries.T, words))

    def candidates(
        self, queries: np.ndarray, home: np.ndarray, codes: np.ndarray, error: np.ndarray, cosine: float
    ) -> np.ndarray:
        """Which codes (by row) may stand for a vector that links with a query (by column).

        The product of a query with what a code stands for is a sum of table entries, each off by half a step at most.
        The vector itself is within ``error`` of that, so its cosine is at most that much higher: no link is lost here.
        """
        centres, words = self.tables(queries)
        total = centres[home]
        part = np.empty_like(total)
        for s, table in enumerate(words):
            # Every byte names a word: without a check of the range the rows go straight into place.
            np.take(table, codes[:, s], axis=0, out=part, mode="clip")
            total += part
        least = (cosine - error) / STEP - (len(words) + 1) / 2 - 2
        return total >= np.floor(least).astype(np.int16)[:, None]


Indexes = dict[int, Index]


def _index_of(indexes: Indexes, size: int, cosine: float) -> Index:
    return indexes.get(size) or Index.plain(size, cosine)


def _rows_of(blobs, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), width)


def _before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether key ``a`` (by row) comes before key ``b`` (by column); keys are pairs of numbers."""
    first, second = a[:, None], b[None, :]
    return (first[..., 0] < second[..., 0]) | ((first[..., 0] == second[..., 0]) & (first[..., 1] < second[..., 1]))


def _vector_rows(indexes: Broadcast, cosine: float):
    """Each distinct vector's bytes, lists, code and the error of its code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                rows = batch.take(pa.array(np.flatnonzero(sizes == size)))
                flat = rows.column("embedding").flatten().to_numpy(zero_copy_only=False)
                vectors = flat.reshape(rows.num_rows, size)
                unit = _unit(vectors.astype(np.float64))
                index = _index_of(indexes.value, size, cosine)
                lists = list(index.visits(unit))
                codes, error = index.coded(unit, np.array([found[0] for found in lists]))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("key"),
                        rows.column("size"),
                        rows.column("copies"),
                        pa.array([v.tobytes() for v in vectors], pa.binary()),
                        pa.array(lists, pa.list_(pa.int32())),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(error, pa.float64()),
                    ],
                    ["key", "size", "copies", "vector", "lists", "code", "error"],
                )

    return run


_VECTORS = "key binary, size int, copies long, vector binary, lists array<int>, code binary, error double"
_TASK = ["size", "list", "i", "j"]


def _find(indexes: Broadcast, cosine: float, kind: str):
    """Members of a list and codes that visit it, those that have a candidate: ``part, visitor, key``."""

    def run(members: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
        out = {"size": [], "list": [], "i": [], "j": [], "part": [], "visitor": [], "key": []}
        if len(members) and len(visitors):
            size, of_list, i, j = (int(members[c].iloc[0]) for c in _TASK)
            index = _index_of(indexes.value, size, cosine)
            unit = _unit(_rows_of(members["vector"], kind, size).astype(np.float64))
            names = [_rows_of(side["key"], ">u8", 2).astype(np.uint64) for side in (members, visitors)]
            home = visitors["home"].to_numpy(np.int64)
            codes = _rows_of(visitors["code"], np.uint8, len(index.books))
            error = visitors["error"].to_numpy(np.float64)
            asked, met = np.zeros(len(unit), bool), np.zeros(len(codes), bool)
            for q in range(0, len(unit), QUERIES):
                ask = slice(q, q + QUERIES)
                for v in range(0, len(codes), CODES):
                    at = slice(v, v + CODES)
                    near = index.candidates(unit[ask], home[at], codes[at], error[at], cosine)
                    own = np.flatnonzero(home[at] == of_list)
                    if len(own):  # two members of the list meet once, and none itself
                        near[own] &= _before(names[1][at][own], names[0][ask])
                    asked[ask] |= near.any(0)
                    met[at] |= near.any(1)
            found = np.flatnonzero(met)
            step = max(1, VECTOR_BYTES // (8 * size))
            keys = [members["key"].iloc[k] for k in np.flatnonzero(asked)]
            for part, lo in enumerate(range(0, len(found), step)):
                some = [visitors["key"].iloc[k] for k in found[lo : lo + step]]
                n = len(some) + len(keys)
                for name, value in zip((*_TASK, "part"), (size, of_list, i, j, part)):
                    out[name] += [value] * n
                out["visitor"] += [True] * len(some) + [False] * len(keys)
                out["key"] += some + keys
        return pd.DataFrame(out)

    return run


def _rerank(cosine: float, kind: str):
    """Links by the cosine in double precision: per key the copies it links with, and a key of its group."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        size, of_list = int(rows["size"].iloc[0]), int(rows["list"].iloc[0])
        side = rows["visitor"].to_numpy(bool)
        key, copies = rows["key"].to_numpy(), rows["copies"].to_numpy(np.int64)
        unit = _unit(_rows_of(rows["vector"], kind, size).astype(np.float64))
        name = _rows_of(key, ">u8", 2).astype(np.uint64)
        home = rows["home"].to_numpy(np.int64)
        # A vector may be on both sides: it is one node of the groups.
        node = np.unique(name, axis=0, return_inverse=True)[1].ravel()
        links, forest = np.zeros(int(node.max()) + 1, np.int64), Forest(int(node.max()) + 1)
        a, b = np.flatnonzero(side), np.flatnonzero(~side)
        for lo in range(0, len(a), QUERIES):
            some = a[lo : lo + QUERIES]
            near = unit[some] @ unit[b].T >= cosine - 1e-9
            own = np.flatnonzero(home[some] == of_list)
            if len(own):
                near[own] &= _before(name[some[own]], name[b])
            x, y = np.nonzero(near)
            for at in range(0, len(x), PAIRS):
                i, j = some[x[at : at + PAIRS]], b[y[at : at + PAIRS]]
                linked = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
                i, j = i[linked], j[linked]
                np.add.at(links, node[i], copies[j])
                np.add.at(links, node[j], copies[i])
                forest.link(node[i], node[j])
        first = np.unique(node, return_index=True)[1]
        some = np.flatnonzero(links)
        return pd.DataFrame(
            {"key": key[first[some]], "links": links[some], "other": key[first[forest.roots(some)]]}
        )

    return run


def fit_indexes(distinct: DataFrame, cosine: float) -> Indexes:
    """An index for each of the most frequent lengths, fitted on a bounded sample of it."""
    common = distinct.groupBy("size").count().orderBy(F.col("count").desc(), "size").limit(LENGTHS).collect()
    found: Indexes = {}
    for size, rows in common:
        if rows < 2:
            continue
        take = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
        sample = distinct.filter(F.col("size") == size).orderBy(F.xxhash64("key"), "key").limit(take)
        vectors = np.array(sample.select("embedding").toPandas()["embedding"].tolist(), np.float64)
        found[size] = Index.fit(_unit(vectors), rows, cosine)
    return found


def linked_copies(distinct: DataFrame, cosine: float) -> DataFrame:
    """Links among distinct vectors (``key, size, copies, embedding``): ``key, links, other``.

    ``links`` adds up, over the rows of a key, the copies of all vectors it links with; ``other`` ties the key into its
    group. Codes go to every list that may hold a neighbour, and to their own; vectors stay in theirs, and only those
    with a candidate are sent to be compared. A list is joined in blocks of bounded bytes, so a list with a third of all
    vectors is many tasks.
    """
    spark = distinct.sparkSession
    indexes = spark.sparkContext.broadcast(fit_indexes(distinct, cosine))
    kind = "<f4" if distinct.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    indexed = cut(distinct.mapInArrow(_vector_rows(indexes, cosine), _VECTORS), "indexed")
    home = indexed.withColumn("list", F.col("lists")[0])
    visits = indexed.select("key", "size", F.col("lists")[0].alias("home"), "code", "error", F.explode("lists").alias("list"))
    by = ["size", "list"]
    members = home.groupBy(*by).agg(F.count("*").alias("m"))
    visitors = visits.groupBy(*by).agg(F.count("*").alias("v"))
    width = F.ceil(F.col("size") / F.lit(SUBSPACE)) + 44
    blocks = members.join(visitors, by).select(
        *by,
        F.ceil(F.col("m") * 8 * F.col("size") / F.lit(VECTOR_BYTES)).cast("int").alias("blocks"),
        F.ceil(F.col("v") * width / F.lit(CODE_BYTES)).cast("int").alias("chunks"),
    )
    blocks = cut(blocks, "list-blocks")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    left = home.join(blocks, by).select(*by, deal("blocks").alias("i"), upto("chunks").alias("j"), "key", "vector")
    right = visits.join(blocks, by).select(
        *by, upto("blocks").alias("i"), deal("chunks").alias("j"), "key", "home", "code", "error"
    )
    left, right = (side.toDF(*side.columns) for side in (left, right))  # columns of their own: both come from one table
    found = left.groupBy(*_TASK).cogroup(right.groupBy(*_TASK)).applyInPandas(
        _find(indexes, cosine, kind), "size int, list int, i int, j int, part int, visitor boolean, key binary"
    )
    found = cut(found, "candidates")
    whole = found.join(indexed.select("key", "copies", "vector", F.col("lists")[0].alias("home")), "key")
    return whole.groupBy(*_TASK, "part").applyInPandas(_rerank(cosine, kind), "key binary, links long, other binary")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Vectors with their near-duplicates by cosine: ``vec_id, n_links, component_id, kept``, a row per row.

    Exact copies are one vector with a count. Distinct vectors go to lists around centres fitted on a bounded sample and
    get residual codes by product quantisation. Sums of table entries bound the cosine of a vector with all codes of the
    lists that may hold a neighbour, nearest or not: a list is left out only if none of it can link, and a code only if
    its stored error proves so. The cosine in double precision of what remains decides, so every link is true and none
    is missed. Vectors without structure meet most others: their cost grows with the square of the table, at a byte for
    each ``SUBSPACE`` dimensions.

    Vectors that are null, zero, or hold null or non-finite components link with nothing, and vectors of different
    lengths never link. Repeated ids are vectors of their own. Null ids are never the smallest; a group of null ids
    alone has a null component_id and all are kept. An empty table gives an empty result. Other columns are ignored.
    """
    value = F.col("embedding")
    wrong = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good: Column = value.isNotNull() & ~wrong & F.exists(value, lambda x: x != 0)
    # Two independent 64-bit hashes name a vector.
    half = lambda h: F.lpad(F.hex(h), 16, "0")
    key = F.unhex(F.concat(half(F.xxhash64(value)), half(F.xxhash64(F.lit(1), value))))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), value, F.when(F.coalesce(good, F.lit(False)), key).alias("key")
    )
    distinct = rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("least")
    )
    distinct = cut(distinct.withColumn("size", F.size("embedding")), "vectors")
    links = cut(linked_copies(distinct, cosine), "vector-links")
    groups = components(links.select(F.col("key").alias("a"), F.col("other").alias("b")), "vector-groups")
    named = distinct.select("key", "copies", "least")
    named = named.join(links.groupBy("key").agg(F.sum("links").alias("links")), "key", "left")
    named = named.join(groups.withColumnRenamed("node", "key"), "key", "left")
    named = named.withColumn("root", F.coalesce("root", "key"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "root").select(
        "key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "key").join(named, "key", "left")
    alone = F.col("key").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
