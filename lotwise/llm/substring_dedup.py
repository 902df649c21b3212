"""Removal of repeated passages: difference-cover anchors find what may repeat, windows decide."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.bpe import text_parts
from lotwise.llm.common import blocks
from lotwise.session import planned_bytes

WINDOW = 20
#: Positions whose remainder by PERIOD is in COVER carry an anchor of ANCHOR words. The differences of COVER are all
#: remainders, so for any two places some shift below PERIOD brings both to the cover; PERIOD - 1 + ANCHOR <= WINDOW
#: keeps that anchor inside the window.
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = 8
BLOCK_BYTES = 8 << 20
#: A bucket of anchors for so many bytes of planned input.
BUCKET_BYTES = 32 << 20
MEMO = 400_000

_MULTIPLIER = 0x9E3779B97F4A7C15


class WordHashes:
    """64-bit hashes of the words of texts, and of all runs of ``k`` words, by prefix sums of a polynomial."""

    def __init__(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def words(self, text: str | None) -> np.ndarray:
        found = [np.empty(0, np.uint64)]
        for part in text_parts(text or ""):
            words = part.split()
            if len(self.memo) > MEMO:
                self.memo.clear()
            for word in set(words).difference(self.memo):
                self.memo[word] = xxhash.xxh64_intdigest(word)
            found.append(np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words)))
        return np.concatenate(found)

    def _grown(self, n: int) -> None:
        if len(self.powers) < n:
            for name, factor in (("powers", _MULTIPLIER), ("inverses", pow(_MULTIPLIER, -1, 1 << 64))):
                factors = np.full(2 * n, factor, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))

    def runs(self, words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
        """Hash of the ``k`` words from each place on; the salt gives an independent hash."""
        n = len(words)
        if n < k:
            return np.empty(0, np.uint64)
        self._grown(n)
        if salt:
            words = _mixed(words + np.uint64(salt))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.powers[:n], dtype=np.uint64)])
        return _mixed((sums[k:] - sums[: n - k + 1]) * self.inverses[: n - k + 1])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _anchors(hashes: WordHashes, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places on the cover with their anchor hashes; none for texts shorter than a window."""
    if len(words) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    found = hashes.runs(words, ANCHOR)
    at = np.flatnonzero(np.isin(np.arange(PERIOD), COVER)[np.arange(len(found)) % PERIOD])
    return at, found[at]


def _row_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows in blocks of bounded text: ``key, doc_id, text, marks``."""

    def rows():
        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                yield tuple(
                    batch.column(c)[i].as_py() if c in names else None for c in ("key", "doc_id", "text", "marks")
                )

    return blocks(rows(), lambda r: len(r[2] or "") + 64, BLOCK_BYTES)


def _bucketed(buckets: int):
    """Anchors of each block by bucket of their hash.

    An anchor that a block holds twice or more is known to repeat: all its places are marked here, and it is sent on
    once. So an anchor that a third of all documents share arrives in its bucket once per block; the marks of a block
    are a group of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        task = TaskContext.get().partitionId()
        for at, block in enumerate(_row_blocks(batches)):
            own = -1 - (task << 32 | at)
            keys, found = [], []
            for key, _, text, _ in {r[0]: r for r in block}.values():
                _, anchors = _anchors(hashes, hashes.words(text))
                keys.append(np.full(len(anchors), key, np.int64))
                found.append(anchors)
            key, anchor = np.concatenate(keys), np.concatenate(found)
            # The bucket and 32 more bits: rare chance matches only bring up windows that are then compared in full.
            bucket = (anchor >> np.uint64(32)) % np.uint64(buckets)
            name = bucket << np.uint64(32) | anchor & np.uint64(0xFFFFFFFF)
            order = np.argsort(name, kind="stable")
            key, name, bucket = key[order], name[order], bucket[order].astype(np.int64)
            fresh = np.concatenate([np.ones(min(1, len(name)), bool), name[1:] != name[:-1]])
            group = np.cumsum(fresh) - 1
            repeats = np.bincount(group)[group] > 1 if len(group) else fresh
            out = {"group": [], "bucket": [], "known": [], "keys": [], "runs": [], "names": []}

            def put(bucket: int, known: bool, key: np.ndarray, name: np.ndarray) -> None:
                """Names by document: each key once, with the number of its names."""
                by = np.argsort(key, kind="stable")
                key, name = key[by], name[by]
                starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
                out["group"].append(own if known else bucket)
                out["bucket"].append(bucket)
                out["known"].append(known)
                out["keys"].append(key[starts].tobytes())
                out["runs"].append(np.diff(np.append(starts, len(key))).astype(np.int32).tobytes())
                out["names"].append((name & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes())

            # Only buckets that the block has, however many there are.
            present, edges = np.unique(bucket, return_index=True)
            for b, lo, hi in zip(present.tolist(), edges.tolist(), [*edges[1:].tolist(), len(bucket)]):
                part = slice(lo, hi)
                put(b, False, key[part][fresh[part]], name[part][fresh[part]])
                if repeats[part].any():
                    put(b, True, key[part][repeats[part]], name[part][repeats[part]])
            yield pa.RecordBatch.from_pydict(
                out,
                pa.schema(
                    {
                        "group": pa.int64(),
                        "bucket": pa.int32(),
                        "known": pa.bool_(),
                        "keys": pa.binary(),
                        "runs": pa.binary(),
                        "names": pa.binary(),
                    }
                ),
            )

    return run


def _repeated(rows: pd.DataFrame) -> pd.DataFrame:
    """Repeating anchors, a row per document and anchor: those of a bucket from two blocks, or what a block knows."""
    keys = np.frombuffer(b"".join(rows["keys"]), np.int64)
    key = np.repeat(keys, np.frombuffer(b"".join(rows["runs"]), np.int32))
    name = np.frombuffer(b"".join(rows["names"]), np.uint32)
    if rows["known"].iloc[0]:
        bucket = np.repeat(rows["bucket"].to_numpy(np.int64), rows["names"].str.len() // 4)
    else:
        bucket = np.int64(rows["bucket"].iloc[0])
        order = np.argsort(name, kind="stable")
        key, name = key[order], name[order]
        same = name[1:] == name[:-1]
        again = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(name) else same
        key, name = key[again], name[again]
    return pd.DataFrame({"key": key, "mark": bucket << 32 | name.astype(np.int64)})


def _candidates(words: np.ndarray, hashes: WordHashes, marks: list[int], buckets: int) -> np.ndarray:
    """Starts of windows that hold an anchor on the cover that repeats somewhere."""
    at, anchors = _anchors(hashes, words)
    name = (anchors >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | anchors & np.uint64(0xFFFFFFFF)
    at = at[np.isin(name.view(np.int64), np.array(marks, np.int64))]
    change = np.zeros(len(words) + 2, np.int64)
    np.add.at(change, np.maximum(at - (WINDOW - ANCHOR), 0), 1)
    np.add.at(change, at + 1, -1)
    return np.flatnonzero(np.cumsum(change)[: len(words) - WINDOW + 1] > 0)


#: ``tail`` holds 32 more bits of the hash above the start: values that differ from row to row stand together, and
#: what repeats from row to row does so too, which compresses well.
_WINDOWS = "hash long, tail long, doc_id long, key long, run int"


def _windows(buckets: int):
    """Candidate windows by the hash of their words; ``run`` is 0.

    Of equal windows in a block only the first can be the first of all. The others are removed for certain and go on as
    runs of ``run`` windows under a hash of no meaning, so a passage that a third of all documents share arrives once
    per block.
    """
    schema = pa.schema(
        {
            "hash": pa.int64(),
            "tail": pa.int64(),
            "doc_id": pa.int64(),
            "key": pa.int64(),
            "run": pa.int32(),
        }
    )

    def batch_of(hash_, check, place, start, run, docs, keys) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(hash_.view(np.int64)),
                pa.array((check.astype(np.uint64) << np.uint64(32) | start.astype(np.uint64)).view(np.int64)),
                docs.take(pa.array(place)),
                keys.take(pa.array(place)),
                pa.array(run.astype(np.int32)),
            ],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for block in _row_blocks(batches):
            rows = sorted({r[0]: r for r in block}.values(), key=lambda r: (r[1] is None, r[1] or 0, r[0]))
            places, starts, ones, twos = [], [], [], []
            for place, (_, _, text, marks) in enumerate(rows):
                words = hashes.words(text)
                at = _candidates(words, hashes, marks, buckets)
                places.append(np.full(len(at), place, np.int64))
                starts.append(at)
                ones.append(hashes.runs(words, WINDOW)[at])
                twos.append(hashes.runs(words, WINDOW, salt=1)[at] >> np.uint64(32))
            place, start, one, two = (np.concatenate(v) for v in (places, starts, ones, twos))
            docs = pa.array([r[1] for r in rows], pa.int64())
            keys = pa.array([r[0] for r in rows], pa.int64())
            order = np.lexsort((np.arange(len(one)), two, one))
            same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
            later = np.zeros(len(one), bool)
            later[order[1:][same]] = True
            first = ~later
            zero = np.zeros(int(first.sum()), np.int64)
            yield batch_of(one[first], two[first], place[first], start[first], zero, docs, keys)
            place, start = place[later], start[later]
            edge = np.concatenate(
                [np.ones(min(1, len(start)), bool), (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]
            )
            at = np.flatnonzero(edge)
            length = np.diff(np.append(at, len(start)))
            spread = _mixed(start[at].astype(np.uint64) + one[later][at])
            yield batch_of(spread, np.zeros(len(at)), place[at], start[at], length, docs, keys)

    return run


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that start earlier elsewhere, from windows sorted by hash, document and start; known runs pass."""
    carried = None  # hash, check, key and start of the first window of the last group
    for batch in batches:
        one, tail, key, run = (batch.column(c).to_numpy() for c in ("hash", "tail", "key", "run"))
        two, start = tail >> 32, (tail & 0xFFFFFFFF).astype(np.int32)
        known = run > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[known]), pa.array(start[known]), pa.array(run[known])], ["key", "start", "run"]
        )
        one, two, key, start = (v[~known] for v in (one, two, key, start))
        if not len(one):
            continue
        fresh = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(one)), 0))
        first_key, first_start = key[head], start[head]
        if carried is not None and carried[:2] == (one[0], two[0]):
            of_old = head == 0
            first_key, first_start = np.where(of_old, carried[2], first_key), np.where(of_old, carried[3], first_start)
        later = (key != first_key) | (start != first_start)
        carried = (one[-1], two[-1], first_key[-1], first_start[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[later]), pa.array(start[later]), pa.array(np.ones(int(later.sum()), np.int32))],
            ["key", "start", "run"],
        )


def _kept_words(text: str | None, marks: list[dict] | None) -> tuple[int, np.ndarray, Iterator[bytes]]:
    """Number of words, which of them stay, and the kept words in joined parts."""
    n = sum(len(part.split()) for part in text_parts(text or ""))
    change = np.zeros(n + 1, np.int64)
    if marks:
        start = np.array([m["start"] for m in marks])
        np.add.at(change, start, 1)
        np.add.at(change, start + np.array([m["run"] for m in marks]) + WINDOW - 1, -1)
    kept = np.cumsum(change[:n]) == 0

    def parts() -> Iterator[bytes]:
        at = 0
        for part in text_parts(text or ""):
            words = part.split()
            keep = kept[at : at + len(words)]
            at += len(words)
            if keep.all() and words:
                yield b" ".join(words)
            elif keep.any():
                yield b" ".join([w for w, k in zip(words, keep.tolist()) if k])

    return n, kept, parts()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, digests = [], [], []
        for text, marks in zip(batch.column("text"), batch.column("marks")):
            n, kept, parts = _kept_words(text.as_py(), marks.as_py())
            digest, first = hashlib.sha256(), True
            for part in parts:
                digest.update(part if first else b" " + part)
                first = False
            counts.append(n)
            removed.append(n - int(kept.sum()))
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [
            b" ".join(_kept_words(text.as_py(), marks.as_py())[2]).decode()
            for text, marks in zip(batch.column("text"), batch.column("marks"))
        ]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.string())], ["doc_id", "text"])


def _bucket_count(docs: DataFrame) -> int:
    """Buckets that stay of one size as the input grows; where its size is not known, as many as shuffle partitions."""
    least = max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, -(-planned_bytes(docs) // BUCKET_BYTES))


def _marked(docs: DataFrame, buckets: int | None) -> DataFrame:
    """Each row's text with the runs of its windows that start earlier elsewhere: ``doc_id, text, marks``."""
    spark = docs.sparkSession
    buckets = buckets or _bucket_count(docs)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(F.xxhash64(doc_id, "text").alias("key"), doc_id.alias("doc_id"), "text")
    blobs = rows.select("key", "text").mapInArrow(
        _bucketed(buckets), "group long, bucket int, known boolean, keys binary, runs binary, names binary"
    )
    marks = blobs.groupBy("group").applyInPandas(_repeated, "key long, mark long")
    marks = marks.groupBy("key").agg(F.collect_list("mark").alias("marks"))
    windows = rows.join(marks, "key").mapInArrow(_windows(buckets), _WINDOWS)
    windows = windows.repartition("hash").sortWithinPartitions(
        "hash", F.shiftright("tail", 32), F.col("doc_id").asc_nulls_last(), "key", "tail"
    )
    later = windows.mapInArrow(_later, "key long, start int, run int")
    runs = later.groupBy("key").agg(F.collect_list(F.struct("start", "run")).alias("marks"))
    return rows.join(runs, "key", "left").select("doc_id", "text", "marks")


def remove_repeats(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Texts without the words that repeated windows cover: ``doc_id, text`` (kept words joined by one space).

    A window is ``WINDOW`` consecutive words. It repeats if the same words also start earlier: in a row with a smaller
    doc_id, or earlier in the same text. All windows are judged on the input.

    Null and empty texts have no words, texts shorter than a window keep all. Null ids count as the largest. Rows with
    the same id but other texts are documents in an order of their own; rows equal in id and text are one document and
    get the same result each. An empty table gives an empty result. Other columns are ignored. ``buckets`` is the
    number of groups that anchors are compared in.
    """
    return _marked(docs, buckets).mapInArrow(_texts, "doc_id long, text string")


def repeat_digests(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Words, removed words and the digest of the kept ones of each row; cases as in :func:`remove_repeats`."""
    return _marked(docs, buckets).mapInArrow(
        _digests, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )
