"""Phrase collocations by sampling with a negative border, then exact counts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import cut
from lotwise.session import planned_bytes

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
SHARE = 100
#: Languages without a name.
UNKNOWN = "und"

#: The share of documents that proposes phrases, and how many deviations below its expected count one is proposed.
SAMPLE = 1 / 8
SLACK = 2.5
#: Text that is hashed together in a task, and the parts that a text is read in.
BLOCK_BYTES = 2 << 20
PART_CHARS = 1 << 20
#: Counts that a task holds, by hash or by phrase, before it sends them on.
HELD_HASHES = 1 << 21
HELD_PHRASES = 200_000
#: Input for each bucket of hashes that are counted together.
BUCKET_BYTES = 4 << 20
#: Bits for each phrase in a filter, and the most bits of one: 32 MB, whatever the corpus.
FILTER_BITS = 16
MOST_BITS = 1 << 28

#: Piece marks become line feeds, tabs spaces, capitals small letters.
_FLAT = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)).lower()
_BREAK = b"\n"
#: An odd multiplier of the rolling hash, and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def flat_parts(text: str) -> Iterator[bytes]:
    """A text in parts of words between spaces, with a line feed where a piece ends."""
    at = 0
    while at < len(text):
        end = at + PART_CHARS
        if end < len(text):
            # A part ends before a space, so no word is cut; without one it goes on to the end.
            end = text.find(" ", end)
            end = len(text) if end < 0 else end
        yield text[at:end].encode().translate(_FLAT)
        at = end


class Powers:
    """Powers of the rolling hash's multiplier and of its inverse, as far as they were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grown(self, n: int) -> Powers:
        if len(self.up) < n:
            n = max(n, BLOCK_BYTES + (BLOCK_BYTES >> 1))
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]), dtype=np.uint64)
                for base in (_BASE, _INVERSE)
            )
        return self


class Stream:
    """Words of many texts one after another, parted by line feeds, found and hashed as one run of bytes.

    ``segments`` are texts or parts: a number for the language, bytes, and how many first words are there only as the
    start of phrases, since the part before has counted them.
    """

    def __init__(self, segments: list[tuple[int, bytes, int]], powers: Powers) -> None:
        self.buffer = b"".join(flat + _BREAK for _, flat, _ in segments)
        data = np.frombuffer(self.buffer, np.uint8)
        n = len(data)
        breaks = data == 10
        gaps = breaks | (data == 32)
        first = ~gaps
        first[1:] &= gaps[:-1]
        starts = np.flatnonzero(first)
        ends = np.flatnonzero(~gaps[:-1] & gaps[1:]) + 1
        # Words and breaks in order.
        self.starts = np.flatnonzero(first | breaks)
        ended = breaks[self.starts]
        self.ends = self.starts + 1
        self.ends[~ended] = ends
        powers = powers.grown(n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * powers.up[:n], dtype=np.uint64)])
        word = (sums[ends] - sums[starts]) * powers.down[starts]
        self.hashes = np.zeros(len(self.starts), np.uint64)
        self.hashes[~ended] = _mixed(word + (ends - starts).astype(np.uint64)) | np.uint64(1)
        sizes = np.array([len(flat) + 1 for _, flat, _ in segments])
        at = np.cumsum(sizes) - sizes
        of = np.searchsorted(at, self.starts, side="right") - 1
        self.lang = np.array([lang for lang, _, _ in segments], np.uint64)[of]
        place = np.arange(len(self.starts)) - np.searchsorted(self.starts, at)[of]
        self.fresh = place >= np.array([seen for _, _, seen in segments])[of]

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Phrases of 1 word, 2 words, and so on: their number of words; by place their hashes, whether there is a
        phrase of that many words, and whether it is to be counted.

        A hash names the words, their order and the language.
        """
        n = len(self.hashes)
        part = np.cumsum(self.hashes == 0)
        value = _mixed(self.hashes ^ self.lang)
        for k in range(1, LONGEST + 1):
            if n < k:
                return
            if k > 1:
                value = _mixed(value[:-1] * np.uint64(_BASE) + self.hashes[k - 1 :])
            # A piece end anywhere in the window rules it out.
            whole = (part[k - 1 :] == part[: n - k + 1]) & (self.hashes[: n - k + 1] != 0)
            yield k, value, whole, whole & self.fresh[k - 1 :]

    def phrase(self, place: int, k: int) -> bytes:
        found = self.buffer[self.starts[place] : self.ends[place + k - 1]]
        return b" ".join(filter(None, found.split(b" ")))


def _streams(rows: Iterator[tuple[str, str]]) -> Iterator[Stream]:
    """Runs of texts (language, text) with about ``BLOCK_BYTES`` in all."""
    powers = Powers()
    segments: list[tuple[int, bytes, int]] = []
    held = 0
    for lang, text in rows:
        number, carry = xxhash.xxh64_intdigest(lang.encode(), 11), []
        for part in flat_parts(text):
            segments.append((number, b" ".join([*carry, part]), len(carry)))
            held += len(part)
            if len(text) > PART_CHARS:
                # What follows may continue a phrase that starts in the last words.
                tail = list(filter(None, part.replace(_BREAK, b" \n ").split(b" ")))
                carry = (carry + tail)[-(LONGEST - 1) :]
            if held >= BLOCK_BYTES:
                yield Stream(segments, powers)
                segments, held = [], 0
    if segments:
        yield Stream(segments, powers)


def _batch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            yield lang.as_py(), text.as_py()


class Filter:
    """A set of hashes as a bitmap of bounded size: all its members are in it, and few others."""

    def __init__(self, bits: int, bitmap: np.ndarray) -> None:
        self.bits, self.bitmap = bits, bitmap

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes & np.uint64(self.bits - 1)).astype(np.int64)
        return (self.bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


Filters = list[list[Filter]]  # by number of words from 1 on; a phrase is a member if any filter of its length has it


def _has(filters: list[Filter], hashes: np.ndarray) -> np.ndarray:
    found = np.zeros(len(hashes), bool)
    for f in filters:
        found |= f.has(hashes)
    return found


def phrase_filters(phrases: DataFrame) -> dict[int, Filter]:
    """A bitmap for each number of words of the phrases (``k, hash``), put together by Spark in pieces of 4 KB."""
    sizes = {r["k"]: r["count"] for r in phrases.groupBy("k").count().collect()}
    bits = 1 << 15
    while bits < min(FILTER_BITS * max(sizes.values(), default=0), MOST_BITS):
        bits *= 2
    at = F.col("hash").bitwiseAND(F.lit(bits - 1))
    pieces = phrases.groupBy("k", F.shiftright(at, 15).alias("piece")).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position((hash & {bits - 1}L) % 32768 + 1))").alias("bitmap")
    )
    found = {k: np.zeros(bits // 8, np.uint8) for k in sizes}
    for r in pieces.collect():  # at most the bits of a filter for each number of words
        part = np.frombuffer(bytes(r["bitmap"]), np.uint8)
        found[r["k"]][r["piece"] * 4096 : r["piece"] * 4096 + len(part)] = part
    return {k: Filter(bits, bitmap) for k, bitmap in found.items()}


class Counts:
    """Counts by number of words and hash, sent on in packs: a row for each bucket of hashes and number of words.

    Counts are cut at ``least``, which is all that matters of them.
    """

    def __init__(self, buckets: int, least: int) -> None:
        self.shift = np.uint64(64 - (buckets - 1).bit_length()) if buckets > 1 else None
        self.kind = "<u1" if least < 256 else "<u4"
        self.least, self.held = least, 0
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def add(self, k: int, hashes: np.ndarray) -> None:
        found = np.unique(hashes, return_counts=True)
        self.parts.setdefault(k, []).append(found)
        self.held += len(found[0])

    def sent(self) -> pa.RecordBatch:
        out = {"bucket": [], "k": [], "hashes": [], "counts": []}
        for k, parts in self.parts.items():
            hashes, counts = summed(*map(np.concatenate, zip(*parts)))
            packed = np.minimum(counts, self.least).astype(self.kind)
            # Sorted hashes lie bucket by bucket: a bucket is their first bits.
            bucket = np.zeros(len(hashes), np.int64) if self.shift is None else (hashes >> self.shift).astype(np.int64)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                out["bucket"].append(int(bucket[lo]))
                out["k"].append(k)
                out["hashes"].append(hashes[lo:hi].tobytes())
                out["counts"].append(packed[lo:hi].tobytes())
        self.parts, self.held = {}, 0
        kinds = {"bucket": pa.int64(), "k": pa.int32(), "hashes": pa.binary(), "counts": pa.binary()}
        return pa.RecordBatch.from_pydict(out, pa.schema(kinds))


def summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, with the sums of their counts."""
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(hashes)), bool), hashes[1:] != hashes[:-1]]))
    return hashes[starts], np.add.reduceat(counts.astype(np.int64), starts) if len(starts) else counts


def _counted(known: Broadcast | None, before: Broadcast | None, lengths: tuple[int, ...], buckets: int, least: int):
    """Counts by hash of phrases of the given lengths whose first and last words but one are ``known``.

    Single words are all counted. Lengths of which nothing is known yet are held to be known: so a sample that knows
    words alone counts all phrases of these words. With ``before``, what was known in a pass over the same documents,
    phrases which that pass counted are left out, and those which it did not are held to be known as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(buckets, least)
        for stream in _streams(_batch_rows(batches)):
            inside = done = None  # whether the phrase of k - 1 words at each place is known (was known before)
            for k, value, whole, fresh in stream.grams():
                counted = False
                reached = whole
                if k > 1:
                    reached = whole & inside[:-1] & inside[1:]
                    if before is not None:
                        counted = done[:-1] & done[1:]
                take = fresh & reached & ~counted if before is not None and k > 1 else fresh & reached
                if k in lengths and take.any():
                    counts.add(k, value[take])
                if k == max(lengths):
                    break
                filters = known.value[k - 1]
                inside = whole & _has(filters, value) if filters else reached
                if before is not None:
                    if k > 1:
                        inside = reached & (inside | ~counted)
                    done = whole & _has(before.value[k - 1], value)
            if counts.held > HELD_HASHES:
                yield counts.sent()
        yield counts.sent()

    return run


def _totals(known: Broadcast | None, least: int):
    """Hashes of a bucket that are found ``least`` times or more; ``proposed`` tells whether they were known."""
    kind = "<u1" if least < 256 else "<u4"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for k, part in rows.groupby("k"):
            hashes = np.frombuffer(b"".join(part["hashes"]), np.uint64)
            hashes, counts = summed(hashes, np.frombuffer(b"".join(part["counts"]), kind))
            hashes = hashes[counts >= least]
            proposed = _has(known.value[int(k) - 1], hashes) if known else np.zeros(len(hashes), bool)
            out.append(pd.DataFrame({"k": int(k), "hash": hashes.view(np.int64), "proposed": proposed}))
        return pd.concat(out)

    return run


def _texts(frequent: Broadcast):
    """Counts of the phrases themselves, of those that the filters of frequent ones hold."""

    def sent(found: Counter[tuple[str, int, bytes]]) -> pa.RecordBatch:
        langs, ks, phrases = zip(*found) if found else ([], [], [])
        columns = [
            pa.array(langs, pa.string()),
            pa.array(ks, pa.int32()),
            pa.array([p.decode() for p in phrases], pa.string()),
            pa.array(found.values(), pa.int64()),
        ]
        found.clear()
        return pa.RecordBatch.from_arrays(columns, ["lang", "k", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[str, int, bytes]] = Counter()
        for batch in batches:
            # A stream has one language, so that its name can go with the counts.
            for lang in batch.column("lang").unique().to_pylist():
                mine = batch.filter(pc.equal(batch.column("lang"), lang))
                for stream in _streams(_batch_rows(iter([mine]))):
                    inside = None
                    for k, value, whole, fresh in stream.grams():
                        known = whole & _has(frequent.value[k - 1], value)
                        if k > 1:
                            known &= inside[:-1] & inside[1:]
                        inside = known
                        at = np.flatnonzero(known & fresh)
                        _, first, counts = np.unique(value[at], return_index=True, return_counts=True)
                        for place, n in zip(at[first].tolist(), counts.tolist()):
                            found[lang, k, stream.phrase(place, k)] += n
                    if len(found) > HELD_PHRASES:
                        yield sent(found)
        yield sent(found)

    return run


def _frequent(docs: DataFrame, known: Filters | None, before: Filters | None, lengths: tuple[int, ...], least: int):
    """Phrases by hash that :func:`_counted` finds ``least`` times or more, over all tasks."""
    sc = docs.sparkSession.sparkContext
    known, before = known and sc.broadcast(known), before and sc.broadcast(before)
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), planned_bytes(docs) // BUCKET_BYTES)
    buckets = 1 << (buckets - 1).bit_length()
    counts = docs.select("lang", "text").mapInArrow(
        _counted(known, before, lengths, buckets, least), "bucket long, k int, hashes binary, counts binary"
    )
    total = counts.groupBy("bucket").applyInPandas(_totals(known, least), "k int, hash long, proposed boolean")
    return cut(total, "phrase-counts")


def _added(filters: Filters, found: DataFrame) -> Filters:
    """The filters, and one more for each number of words of the phrases found."""
    more = phrase_filters(found)
    return [old + ([more[k]] if k in more else []) for k, old in enumerate(filters, 1)]


def frequent_filters(docs: DataFrame, least: int = MIN_COUNT, sample: float = SAMPLE) -> tuple[Filters, int]:
    """Filters that hold every phrase of ``docs`` found ``least`` times or more, and the number of passes over all.

    ``docs`` has ``lang, text`` and ``draw``, a hash of the row. Single words are counted over all documents: each is
    proposed or on the border. A sample of the documents, those with small draws, then proposes longer phrases of
    frequent words at a lower threshold. One pass over all documents counts those and the negative border: phrases that
    are not proposed while their first and last words but one are. Phrases of the border that turn out frequent open a
    new border around them, and that another one: the next pass takes whatever it has not seen counted as proposed, so it
    counts all of these borders at once. Were a frequent phrase still not counted, a shortest one would have first and
    last words but one that are frequent and counted, hence known in one of the two passes, which then counted it.

    Counts are by hash: equal hashes of different phrases only add to a count, so nothing frequent is lost.
    """
    longer = tuple(range(2, LONGEST + 1))
    words = _frequent(docs, None, None, (1,), least)
    frequent = _added([[] for _ in range(LONGEST)], words)
    passes = 1
    if not frequent[0]:
        return frequent, passes
    # The sample: a phrase is proposed if it is not much rarer there than a frequent one would be.
    part = docs.filter(F.pmod(F.col("draw"), F.lit(1 << 20)) < int(sample * (1 << 20)))
    expected = least * sample
    low = max(1, math.floor(expected - SLACK * math.sqrt(expected)))
    proposed = _closed(_added(frequent, _frequent(part, frequent, None, longer, low)))
    found = _frequent(docs, proposed, None, longer, least)
    frequent, passes = _added(frequent, found), passes + 1
    failed = found.filter(~F.col("proposed") & (F.col("k") < LONGEST))
    if not failed.isEmpty():
        more = _frequent(docs, _added(proposed, failed), proposed, longer, least)
        frequent, passes = _added(frequent, more), passes + 1
    return frequent, passes


def _closed(filters: Filters) -> Filters:
    """An empty filter where a length has none: nothing of it is known."""
    empty = Filter(1 << 15, np.zeros(1 << 12, np.uint8))
    return [of_length or [empty] for of_length in filters]


def phrase_counts(docs: DataFrame, least: int = MIN_COUNT, sample: float = SAMPLE) -> DataFrame:
    """Phrases of 1 to 5 words found ``least`` times or more in a language: ``lang, k, phrase, n``, counted exactly."""
    filters, _ = frequent_filters(docs, least, sample)
    frequent = docs.sparkSession.sparkContext.broadcast(filters)
    counts = docs.select("lang", "text").mapInArrow(_texts(frequent), "lang string, k int, phrase string, n long")
    total = counts.groupBy("lang", "phrase").agg(F.first("k").alias("k"), F.sum("n").alias("n"))
    return cut(total.filter(F.col("n") >= least), "phrases")


def collocations(
    docs: DataFrame, least: int = MIN_COUNT, top: int = TOP, share: int = SHARE, sample: float = SAMPLE
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and those into words at spaces and
    tabs. Candidates are phrases of 2 to 5 words found ``a >= least`` times within pieces. A cut of a candidate into a
    first part found ``l`` times and a rest found ``r`` times scores ``floor(1000 * a * n / (l * r))``, ``n`` being all
    words of the language; the lowest cut counts, the first of equal ones. A candidate inside a longer one that has
    ``share`` percent of its occurrences is dropped. Counts are exact (see :func:`frequent_filters` for what is
    counted), and so is the arithmetic.

    Null and empty texts hold no words. Documents without a language are those of ``und``. Every row counts, repeated
    ones too; ids only draw the sample. An empty table gives an empty result. Other columns are ignored.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    # Copies of a text are drawn each on its own, where rows have ids.
    draw = F.xxhash64(F.lit(5), *(["doc_id"] if "doc_id" in docs.columns else []), "text").alias("draw")
    rows = docs.filter(F.col("text").isNotNull()).select(lang, "text", draw)
    found = phrase_counts(rows, least, sample)
    words = F.sum(F.regexp_count("text", F.lit(r"[^ \t.,;:!?\n\x0B\f\r]+"))).cast("long")
    totals = cut(rows.groupBy("lang").agg(words.alias("n")), "words")
    part = found.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    candidates = found.filter("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"))
    piece = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    split = candidates.withColumn("words", F.split("phrase", " ", -1))
    # A row per cut: both parts are frequent themselves, so they are in the table.
    cuts = split.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", piece(1, F.col("cut")).alias("head"), piece(F.col("cut") + 1, F.col("k")).alias("tail"))
    of = lambda side, name: part.select("lang", F.col("part").alias(side), F.col("f").alias(name))
    cuts = cuts.join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"]).join(totals, "lang")
    # Products of three counts may pass 64 bits; decimals of 38 digits hold them.
    wide = lambda c, digits=19: F.col(c).cast(f"decimal({digits},0)")
    cuts = cuts.withColumn("over", (wide("a") * 1000).cast("decimal(19,0)") * wide("n"))
    cuts = cuts.withColumn("under", wide("l") * wide("r")).withColumn("score", F.expr("over div under"))
    scored = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best")
    ).select("lang", "phrase", "best.*")
    # What a longer candidate holds: all runs of two words or more inside it.
    spans = F.transform(
        F.sequence(F.lit(2), F.col("k") - 1),
        lambda length: F.transform(F.sequence(F.lit(1), F.col("k") - length + 1), lambda start: piece(start, length)),
    )
    inside = split.filter("k > 2").select("lang", "a", F.explode(F.array_distinct(F.flatten(spans))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * share)
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
