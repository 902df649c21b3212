"""Token counts of a byte-level BPE vocabulary; huge documents in overlapping chunks."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import cut

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
#: Pieces whose counts a task remembers, and pieces given to the library at once.
MEMO = 400_000
BATCH = 20_000

#: White space outside ASCII, and characters that Python alone takes for it: no cut is made after these.
_ODD = r"\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A piece starts at white space that follows a character of another kind. The split pattern of byte-level BPE has no
#: match across such a place and looks back at nothing, so pieces are tokenised independently of each other.
_PIECE = re.compile(rf"[ \t-\r]*[^ \t-\r]+(?:(?<=[{_ODD}])[ \t-\r]+[^ \t-\r]*)*|[ \t-\r]+")


def check_split(spec: dict) -> None:
    """Raises unless a tokenizer file cuts text like byte-level BPE does by default: ``_PIECE`` holds for no other."""
    split = spec.get("pre_tokenizer") or {}
    wanted = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if spec.get("normalizer") is not None or {k: split.get(k) for k in wanted} != wanted:
        raise ValueError("token counts need a byte-level split without a prefix space, and no normaliser")
    if any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", ())):
        raise ValueError("token counts need special tokens that hold and take in no white space")


class Counter:
    """Counts tokens of pieces with the library; a piece that came before is not encoded again."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        check_split(json.loads(self.tokenizer.to_str()))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[str, int] = {}

    def learn(self, pieces: Iterable[str]) -> None:
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = list(set(pieces).difference(self.memo))
        for at in range(0, len(new), BATCH):
            part = new[at : at + BATCH]
            encoded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.memo.update(zip(part, map(len, encoded)))

    def counts(self, texts: list[str]) -> list[int]:
        pieces = [_PIECE.findall(text) for text in texts]
        self.learn(p for of_text in pieces for p in of_text)
        count = self.memo.__getitem__
        return [sum(map(count, of_text)) for of_text in pieces]

    def cuts(self, text: str, start: int, head: int, tail: int) -> tuple[list[int], list[int], int]:
        """Places in the head and the tail of a chunk where a piece starts, tokens before each, and all tokens.

        ``start`` is the chunk's place in its document; ``head`` and ``tail`` are the places where its overlaps end and
        begin. The start of the chunk itself is no such place.
        """
        pieces = _PIECE.findall(text)
        self.learn(pieces)
        at, tokens, places, before = start, 0, [], []
        for piece in pieces:
            if at > start and (at < head or at >= tail):
                places.append(at)
                before.append(tokens)
            at += len(piece)
            tokens += self.memo[piece]
        return places, before, tokens


def _blocks(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows of a batch with about ``most`` characters of text."""
    start, held, texts = 0, 0, []
    for i, value in enumerate(batch.column(column)):
        texts.append(value.as_py())
        held += len(texts[-1])
        if held >= most:
            yield start, texts
            start, held, texts = i + 1, 0, []
    if texts:
        yield start, texts


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            counts = [n for _, texts in _blocks(batch, "text") for n in counter.counts(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return run


_KEY = ["text_hash", "other_hash", "n_bytes"]
_CHUNK = (
    "text_hash long, other_hash long, n_bytes long, k long, places array<long>, before array<long>, tokens long, last boolean"
)


def _chunk(path: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            rows = []
            for k, text in zip(batch.column("k").to_pylist(), batch.column("text")):
                rows.append(counter.cuts(text.as_py(), k * chunk, k * chunk + overlap, (k + 1) * chunk))
            places, before, tokens = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in [*_KEY, "k"]),
                    pa.array(places, pa.list_(pa.int64())),
                    pa.array(before, pa.list_(pa.int64())),
                    pa.array(tokens, pa.int64()),
                    batch.column("last"),
                ],
                [*_KEY, "k", "places", "before", "tokens", "last"],
            )

    return run


def _chunked(docs: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Counts of ``docs`` by overlapping chunks: the key, ``n_tokens`` (null where an overlap holds no common cut)."""
    chars = F.length("text")
    # The last chunk is the first one that reaches the end.
    last = F.greatest(F.ceil((chars - overlap) / F.lit(chunk)) - 1, F.lit(0))
    chunks = docs.select(*_KEY, "text", last.alias("end"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"))
    part = F.substring("text", (F.col("k") * chunk + 1).cast("int"), F.lit(chunk + overlap))
    # Spread: the chunks of one document go to many tasks.
    chunks = chunks.select(*_KEY, "k", (F.col("k") == F.col("end")).alias("last"), part.alias("text")).repartition(
        "text_hash", "k"
    )
    counted = chunks.mapInArrow(_chunk(path, chunk, overlap), _CHUNK)
    order = Window.partitionBy(*_KEY).orderBy("k")
    following = F.lead("places").over(order)
    common = F.array_min(F.array_intersect("places", following))
    spliced = counted.withColumn("to", F.when(~F.col("last"), common)).withColumn("from", F.lag("to").over(order))
    tokens_at = lambda place: F.element_at("before", F.array_position("places", place).cast("int"))
    part = F.when(F.col("last"), F.col("tokens")).otherwise(tokens_at(F.col("to"))) - F.when(
        F.col("k") == 0, F.lit(0)
    ).otherwise(tokens_at(F.col("from")))
    return spliced.groupBy(*_KEY).agg(F.when(F.count(part) == F.count("*"), F.sum(part)).alias("n_tokens"))


def count_tokens(
    docs: DataFrame, path: str, limit: int = 1024, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> DataFrame:
    """Tokens of each text as the library gives them: ``doc_id, n_bytes, n_tokens, over_limit``.

    Texts of more than ``chunk`` characters are cut into chunks that overlap by ``overlap``, each encoded where it
    lands, and equal texts once. Two neighbours are spliced at a place in their overlap where both start a piece (see
    ``_PIECE``). Documents with an overlap that holds no such place are counted again with chunks and overlaps twice as
    wide, until every one is spliced; at the latest a document is one chunk.

    A null text counts as empty, with 0 tokens. Repeated rows, and null or repeated ids, are counted row by row. An
    empty table gives an empty result. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    whole = F.length("text") <= chunk
    short = rows.filter(whole).mapInArrow(_count(path), "doc_id long, n_bytes long, n_tokens long")
    hashes = [F.xxhash64("text").alias("text_hash"), F.xxhash64(F.lit(1), "text").alias("other_hash")]
    named = rows.filter(~whole).select("doc_id", *hashes, "n_bytes", "text")
    # A text that many rows hold is cut and counted once; copies meet before the shuffle as well.
    huge = cut(named.groupBy(*_KEY).agg(F.first("text").alias("text")), "huge-texts")
    open_docs, found = huge, []
    while True:
        spliced = cut(_chunked(open_docs, path, chunk, overlap), "token-chunks")
        found.append(spliced.filter("n_tokens IS NOT NULL"))
        failed = spliced.filter("n_tokens IS NULL")
        if failed.isEmpty():
            break
        chunk, overlap = chunk * 2, overlap * 2
        open_docs = huge.join(failed.select(*_KEY), _KEY, "left_semi")
    counts = found[0]
    for more in found[1:]:
        counts = counts.unionByName(more)
    long = named.select("doc_id", *_KEY).join(counts, _KEY).select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)
