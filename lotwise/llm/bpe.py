"""Byte-pair encoding by an index of pair occurrences, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task encodes together, and words whose result it remembers.
BLOCK_BYTES = 8 << 20
MEMO = 400_000

#: Words of these characters need no Unicode tables: composed letters whose lower case is one character.
_PLAIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
_PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ \t-\r]+")
_NONE = np.iinfo(np.int32).max


def _byte_symbols() -> list[str]:
    """The character that byte-level vocabularies use for each byte: itself if printable, else the next free one."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class PairIndex:
    """Applies the merges of a vocabulary to many words at once.

    All words of a block stand in one array of symbols. The index maps each pair's rank to the positions where the pair
    occurs. Ranks in use are taken in ascending order; a rank merges all its positions, and only the pairs beside these
    change and enter the lists of their new ranks. As every merge uses only symbols that earlier merges make, a merge
    never brings up a lower rank, so this order is each word's own order.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        symbols = _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + suffix] for s in symbols], np.int64)
        made = set(self.inner.tolist()) | set(self.final.tolist())
        left, right, result = [], [], []
        for a, b in merges:
            left.append(vocab[a])
            right.append(vocab[b])
            result.append(vocab[a + b])
            if left[-1] not in made or right[-1] not in made or result[-1] in made:
                raise ValueError(f"merge {a!r} {b!r} comes before its parts or makes a known symbol")
            made.add(result[-1])
        self.result = np.array(result, np.int64)
        self.same = np.array(left) == np.array(right)
        key = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        self.ranks = np.argsort(key, kind="stable")
        self.keys = key[self.ranks]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and where each word's begin and end (one more place than words). No word is empty."""
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        n = len(flat)
        symbol = self.inner[flat]
        if n:
            symbol[ends - 1] = self.final[flat[ends - 1]]
        following = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        if n:
            following[ends - 1] = -1
            before[ends[:-1]] = -1
            before[0] = -1
        alive = np.ones(n, bool)
        current = np.full(n, _NONE, np.int64)
        starts = np.flatnonzero(following >= 0)
        current[starts] = self.rank(symbol[starts], symbol[starts + 1])

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(places: np.ndarray) -> None:
            ranks = current[places]
            places, ranks = places[ranks < _NONE], ranks[ranks < _NONE]
            if not len(places):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            edges = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for lo, hi in zip(edges, edges[1:]):
                r = int(ranks[lo])
                if r in index:
                    index[r].append(places[lo:hi])
                else:
                    index[r] = [places[lo:hi]]
                    heapq.heappush(active, r)

        enter(starts)
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[current[at] == r]
            if not len(at):
                continue
            if self.same[r]:  # in a run of one symbol, every other pair merges, from the left
                follows = np.concatenate([[False], following[at[:-1]] == at[1:]])
                place = np.arange(len(at))
                first = np.maximum.accumulate(np.where(follows, 0, place))
                at = at[(place - first) % 2 == 0]
            gone = following[at]
            after = following[gone]
            symbol[at] = self.result[r]
            alive[gone] = False
            current[gone] = _NONE
            following[at] = after
            joined = after >= 0
            before[after[joined]] = at[joined]
            current[at] = _NONE
            right = at[joined]
            current[right] = self.rank(symbol[right], symbol[after[joined]])
            left = before[at]
            left = left[left >= 0]
            current[left] = self.rank(symbol[left], symbol[following[left]])
            enter(np.concatenate([right, left]))
        counts = np.concatenate([[0], np.cumsum(alive)])
        return symbol[alive], counts[np.concatenate([[0], ends])] if n else np.zeros(1, np.int64)


#: Fixed values of the file format that the encoder stands for.
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def check_split(spec: dict) -> None:
    """Raises unless a tokenizer file normalises and splits text the way that words are cut here."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    if (spec.get("normalizer") or {}).get("normalizers") != NORMALIZERS:
        raise ValueError("the encoder needs lower-casing after NFC and white space made one space")
    if steps[0].get("pattern") != {"Regex": SPLIT} or [s.get("type") for s in steps] != ["Split", "ByteLevel"]:
        raise ValueError("the encoder needs the word split that it is written for")
    if spec.get("decoder") is not None or not spec["model"].get("end_of_word_suffix"):
        raise ValueError("the encoder needs word ends and no decoder")


class WordBpe:
    """Encoder and decoder of a tokenizer file with lower-casing, word ends and no decoder."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        check_split(spec)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.index = PairIndex(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, reverse=True))) + ")")
        ids = {**model["vocab"], **self.special}
        self.tokens = [""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            self.tokens[i] = token
        # Unicode normal forms, letter classes and splits of other words come from the library's own parts.
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.to_byte = {s: b for b, s in enumerate(_byte_symbols())}
        #: Word to ids (little-endian, 32 bits) and decoded text.
        self.memo: dict[bytes, tuple[bytes, str]] = {}

    def _parts(self, word: str) -> list[bytes | int]:
        """A white-space separated word as pre-tokens in UTF-8, and ids of special tokens."""
        parts: list[bytes | int] = []
        for piece in self.special_split.split(word) if "<|" in word else (word,):
            if piece in self.special:
                parts.append(self.special[piece])
            elif _PLAIN.fullmatch(piece):
                parts += [p.encode() for p in _PLAIN_SPLIT.findall(piece.lower())]
            elif piece:
                found = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(piece))
                parts += [bytes(self.to_byte[c] for c in p) for p, _ in found]
        return parts

    def learn(self, words: set[bytes]) -> None:
        """Encode the words that the memo lacks: all their pre-tokens in one pair index."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        parts = {w: self._parts(w.decode()) for w in words.difference(self.memo)}
        distinct = list({p for of_word in parts.values() for p in of_word if isinstance(p, bytes)})
        ids, edges = self.index.encode(distinct)
        edges = edges.tolist()
        place = {p: i for i, p in enumerate(distinct)}
        everything = ids.tolist()
        packed = ids.astype("<u4")
        for word, of_word in parts.items():
            raw, shown = [], []
            for p in of_word:
                if isinstance(p, int):
                    raw.append(p.to_bytes(4, "little"))
                    shown.append(self.tokens[p])
                else:
                    lo, hi = edges[place[p]], edges[place[p] + 1]
                    raw.append(packed[lo:hi].tobytes())
                    shown += [self.tokens[i] for i in everything[lo:hi]]
            self.memo[word] = b"".join(raw), " ".join(shown)

    def encode(self, words: list[bytes]) -> bytes:
        return b"".join([self.memo[w][0] for w in words])

    def decode(self, ids: np.ndarray) -> str:
        """The tokens, with a space between two: the library's result for a file without a decoder."""
        return " ".join([self.tokens[i] for i in ids.tolist()])


def text_parts(text: str, most: int = BLOCK_BYTES) -> Iterator[bytes]:
    """A text in UTF-8 in parts of about ``most`` characters, cut before white space; a longer word stays whole."""
    at = 0
    while at < len(text):
        end = at + most
        if end < len(text):
            found = _SPACE.search(text, end)
            end = found.start() if found else len(text)
        yield text[at:end].encode()
        at = end


_SPACE = re.compile(r"[ \t-\r]")
_OUT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _row_parts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, bool]]:
    """Row, part of its text, whether it is the last one. A null or empty text has one empty part."""
    for row, value in enumerate(batch.column("text")):
        parts = text_parts(value.as_py() or "")
        held = next(parts, b"")
        for part in parts:
            yield row, held, False
            held = part
        yield row, held, True


def encoded_words(bpe: WordBpe, batch: pa.RecordBatch) -> Iterator[tuple[bytes, str, bool]]:
    """Ids and decoded text of each part of the rows of a batch, and whether it ends its row."""
    from lotwise.llm.common import blocks

    for block in blocks(_row_parts(batch), lambda x: len(x[1]) + 64, BLOCK_BYTES):
        # Normal form, lower case and split pattern never reach across white space, so words are independent.
        words = [part.split() for _, part, _ in block]
        bpe.learn(set().union(*words))
        memo = bpe.memo
        for of_part, (_, _, last) in zip(words, block):
            found = [memo[w] for w in of_part]
            yield b"".join([f[0] for f in found]), " ".join([f[1] for f in found if f[1]]), last


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(path)
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            n, ids, shown = 0, hashlib.sha256(), hashlib.sha256()
            for raw, text, last in encoded_words(bpe, batch):
                ids.update(raw)
                if text:
                    shown.update((" " + text if n else text).encode())
                n += len(raw) // 4
                if last:
                    counts.append(n)
                    id_digests.append(ids.hexdigest())
                    text_digests.append(shown.hexdigest())
                    n, ids, shown = 0, hashlib.sha256(), hashlib.sha256()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_digests), pa.array(text_digests)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(path)
        for batch in batches:
            found, held = [], []
            for raw, _, last in encoded_words(bpe, batch):
                held.append(raw)
                if last:
                    found.append(np.frombuffer(b"".join(held), "<u4").astype(np.int32))
                    held = []
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(path)
        for batch in batches:
            texts = [bpe.decode(np.array(ids.as_py() or [], np.int64)) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Token ids of each text: ``doc_id, ids``; cases as in :func:`encode_digests`."""
    return _texts(docs).mapInArrow(_encode(path), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Texts of ``doc_id, ids``, special tokens shown; a null array is an empty text."""
    ids = F.col("ids").cast("array<int>")
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), ids.alias("ids")).mapInArrow(
        _decode(path), "doc_id long, text string"
    )


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode each whole text: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Ids are those of the library with ``add_special_tokens=False``; special tokens inside texts become their ids.
    Tasks hold a block of text at a time, also of a very long one, and remember a bounded number of words.

    A null text is an empty one: no tokens, digests of nothing. Repeated rows and ids, and null ids, give a row each.
    An empty table gives an empty result. Other columns are ignored.
    """
    return _texts(docs).mapInArrow(_digests(path), f"doc_id long, {_OUT}")
