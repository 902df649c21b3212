"""Toxic spans by a linear-chain conditional random field; document scores from its marginals."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import cut

FOLDS = 5
#: The model is fitted on at most so many texts of each label, of at most so many bytes each: those whose hashes of the
#: id are smallest. Ids are taken this many times over, as some have no text that fits.
SAMPLE_ROWS = 2000
SAMPLE_TEXT = 1 << 14
SPARE = 4
#: Of two sampled texts that share this part of their runs of five words, one is left out: copies are no evidence.
SAME = 0.5
#: A word of a toxic text is labelled toxic if it, or how it begins, is likelier in toxic texts by this much (log odds),
#: and that by chance in about one of fifty thousand words (the statistic of a likelihood-ratio test).
LIKELIER, EVIDENCE = 1.5, 18.0
BEGINNINGS = (4, 5, 6)
#: A feature needs so many words of the sample, a neighbour so many; small weights are left out.
RARE, NEIGHBOUR, LEAST_WEIGHT = 3, 30, 0.02
ROUNDS, RATE, PENALTY = 30, 0.5, 1.0

#: Text that is tagged together, and the length at which a text is cut at the next sentence end.
BLOCK_CHARS = 1 << 21
PART_CHARS = 1 << 20
MEMO = 400_000
TAGGED = 0.5
LIMIT = 12.0

_TOKEN = re.compile(r"[^\W_]+|[.!?;:\n]+")
_ENDS = frozenset(".!?;:\n")
_END = re.compile(r"[.!?;:\n]")


def features(word: str) -> list[str]:
    """What a word is known by: itself, how it begins and ends, and its shape."""
    low = word.lower()
    found = [f"w {low}"]
    found += [f"p {low[:n]}" for n in (3, 4, 5, 6) if len(low) > n]
    found += [f"s {low[-n:]}" for n in (3, 4) if len(low) > n]
    if len(word) > 1 and word.isupper():
        found.append("capitals")
    if any(c.isdigit() for c in word):
        found.append("digits")
    return found


def _logit(p: np.ndarray) -> np.ndarray:
    return np.log(p) - np.log1p(-p)


class Chains:
    """Words in runs between sentence ends. A step handles one place of all runs that are as long."""

    def __init__(self, ids: np.ndarray) -> None:
        """``ids``: word numbers, 0 for the end of a run."""
        inside = ids != 0
        starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
        ends = np.flatnonzero(inside & np.concatenate([~inside[1:], [True]])) + 1
        order = np.argsort(starts - ends, kind="stable")
        self.starts, self.lengths = starts[order], (ends - starts)[order]
        longest = int(self.lengths[0]) if len(starts) else 0
        # Runs longer than t: the first ones.
        self.alive = np.searchsorted(-self.lengths, -np.arange(longest), side="left")

    def forward(self, e: np.ndarray, start: float, t: np.ndarray) -> np.ndarray:
        """Log odds of label 1 given the words up to each place."""
        out = np.zeros(len(e))
        for k, n in enumerate(self.alive):
            at = self.starts[:n] + k
            if k == 0:
                out[at] = e[at] + start
            else:
                before = out[at - 1]
                out[at] = e[at] + np.logaddexp(t[0, 1], t[1, 1] + before) - np.logaddexp(t[0, 0], t[1, 0] + before)
        return out

    def backward(self, e: np.ndarray, t: np.ndarray) -> np.ndarray:
        """What the words after each place add to the log odds of its label."""
        out = np.zeros(len(e))
        for k in range(len(self.alive) - 2, -1, -1):
            at = self.starts[: self.alive[k + 1]] + k
            after = e[at + 1] + out[at + 1]
            out[at] = np.logaddexp(t[1, 0], t[1, 1] + after) - np.logaddexp(t[0, 0], t[0, 1] + after)
        return out


@dataclass
class Field:
    """Weights of a chain over words with labels 0 (clean) and 1 (toxic), and of the score of a document."""

    word: dict[str, float] = field(default_factory=dict)
    left: dict[str, float] = field(default_factory=dict)
    right: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    start: float = 0.0
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    #: Constant, weight of the strongest word, weight of the number of tagged words.
    score: tuple[float, float, float] = (0.0, 0.0, 0.0)


class Tagger:
    """A field applied to texts; what a word adds is computed once."""

    def __init__(self, model: Field) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[str, int] = {}
        self.weights = [array("d", [0.0]) for _ in range(3)]  # own, for the next word, for the word before

    def _number(self, word: str) -> int:
        if word[0] in _ENDS:
            number = 0
        else:
            m, low = self.model, word.lower()
            own = m.bias + sum(m.word.get(f, 0.0) for f in features(word))
            number = len(self.weights[0])
            for column, value in zip(self.weights, (own, m.left.get(low, 0.0), m.right.get(low, 0.0))):
                column.append(value)
        self.ids[word] = number
        return number

    def odds(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of label 1 for each token by its marginal, and which tokens are words."""
        if len(self.ids) > MEMO:
            self._forget()
        known, number = self.ids.get, self._number
        ids = np.fromiter((known(w) or number(w) for w in tokens), np.int64, len(tokens))
        e, left, right = (np.array(column)[ids] for column in self.weights)
        e[1:] += left[:-1]
        e[:-1] += right[1:]
        chains, m = Chains(ids), self.model
        return chains.forward(e, m.start, m.steps) + chains.backward(e, m.steps), ids != 0


def text_parts(text: str) -> Iterator[tuple[int, str]]:
    """Parts of a text with their places: cut after a sentence end, so that no run of words is; where there is none in
    as many characters again, at white space."""
    at = 0
    while at < len(text):
        end = at + PART_CHARS
        if end < len(text):
            found = _END.search(text, end, end + PART_CHARS) or re.compile(r"\s").search(text, end + PART_CHARS)
            end = found.end() if found else len(text)
        yield at, text[at:end]
        at = end


#: Of a document: log odds of its strongest word, expected number of tagged words, tagged spans.
Found = tuple[float, float, list[tuple[int, int, float]]]


def _tag(tagger: Tagger, parts: list[tuple[int, str]]) -> list[Found]:
    """Findings of parts of texts, tagged together."""
    tokens, counts = [], []
    for _, text in parts:
        found = _TOKEN.findall(text)
        tokens += found
        tokens.append("\n")
        counts.append(len(found) + 1)
    odds, words = tagger.odds(tokens)
    odds = np.where(words, np.clip(odds, -LIMIT, LIMIT), -LIMIT)
    starts = np.cumsum(counts) - counts
    strongest = np.maximum.reduceat(odds, starts) if len(parts) else odds
    tagged = 1 / (1 + np.exp(-odds)) * (odds >= _logit(np.array(TAGGED)))
    sums = np.add.reduceat(tagged, starts) if len(parts) else tagged
    out = []
    for (at, text), start, n, most, total in zip(parts, starts.tolist(), counts, strongest.tolist(), sums.tolist()):
        spans: list[tuple[int, int, float]] = []
        if total:
            mine, last = tagged[start : start + n].tolist(), -2
            for i, match in enumerate(_TOKEN.finditer(text)):
                if mine[i]:
                    if last == i - 1:
                        first, _, p = spans.pop()
                        spans.append((first, at + match.end(), max(p, mine[i])))
                    else:
                        spans.append((at + match.start(), at + match.end(), mine[i]))
                    last = i
        out.append((most, total, spans))
    return out


def tag_texts(tagger: Tagger, texts: Iterator[str]) -> Iterator[Found]:
    """Findings of each whole text, in order; texts are tagged in blocks of bounded size."""
    block: list[tuple[int, str]] = []
    owner: list[int] = []
    done: dict[int, Found] = {}
    held, n = 0, 0

    def run() -> None:
        for i, (most, total, spans) in zip(owner, _tag(tagger, block)):
            old = done.get(i, (-LIMIT, 0.0, []))
            done[i] = (max(old[0], most), old[1] + total, old[2] + spans)

    first = 0
    for n, text in enumerate(texts, 1):
        done[n - 1] = (-LIMIT, 0.0, [])
        for part in text_parts(text):
            block.append(part)
            owner.append(n - 1)
            held += len(part[1])
            if held >= BLOCK_CHARS:
                run()
                block, owner, held = [], [], 0
        if not block:
            for i in range(first, n):
                yield done.pop(i)
            first = n
    if block:
        run()
    for i in range(first, n):
        yield done.pop(i)


def document_score(model: Field, most: float, total: float) -> float:
    constant, strongest, number = model.score
    return float(1 / (1 + np.exp(-np.clip(constant + strongest * most + number * np.log1p(total), -30, 30))))


def _different(texts: list[str]) -> list[int]:
    """Places of texts that are no copies of earlier ones."""
    seen: set[int] = set()
    kept = []
    for place, text in enumerate(texts):
        words = text.split()
        runs = {hash(tuple(words[i : i + 5])) for i in range(max(1, len(words) - 4))}
        if len(runs & seen) < SAME * len(runs):
            kept.append(place)
        seen |= runs
    return kept


def label_words(texts: list[list[str]], toxic: list[int]) -> list[np.ndarray]:
    """Labels of the words of labelled texts: in toxic texts, the words that toxic texts have and others have not."""
    names = lambda word: [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]
    of_label: list[Counter[str]] = [Counter(), Counter()]
    for words, label in zip(texts, toxic):
        of_label[label].update({name for word in set(words) for name in names(word)})
    n1, n0 = sum(toxic), len(toxic) - sum(toxic)

    def strong(name: str) -> bool:
        a, b = of_label[1][name], of_label[0][name]
        odds = np.log((a + 0.5) / (n1 + 0.5 - a)) - np.log((b + 0.5) / (n0 + 0.5 - b))
        if odds < LIKELIER:
            return False
        expected = (a + b) / (n1 + n0)
        return 2 * (a * np.log(a / (expected * n1)) + (b * np.log(b / (expected * n0)) if b else 0)) >= EVIDENCE

    telling = {name for name, n in of_label[1].items() if n >= 5 and strong(name)}
    marked: dict[str, bool] = {}
    out = []
    for words, label in zip(texts, toxic):
        for word in set(words) if label else ():
            if word not in marked:
                marked[word] = not telling.isdisjoint(names(word))
        out.append(np.array([bool(label) and marked[w] for w in words], bool))
    return out


def fit_field(texts: list[list[str]], labels: list[np.ndarray]) -> Field:
    """A field fitted to labelled tokens (sentence ends included) by full steps of adaptive size."""
    tokens = [w for words in texts for w in [*words, "\n"]]
    y = np.concatenate([np.append(part, False) for part in labels]).astype(np.float64)
    number: dict[str, int] = {}
    ids = np.array([0 if w[0] in _ENDS else number.setdefault(w, len(number) + 1) for w in tokens])
    kinds = len(number) + 1
    times = np.bincount(ids, minlength=kinds)
    # Features of each kind of word, as a flat table of pairs.
    pairs = [(kind, name) for word, kind in number.items() for name in features(word)]
    kind = np.array([p[0] for p in pairs])
    code: dict[str, int] = {}
    feature = np.array([code.setdefault(p[1], len(code)) for p in pairs])
    common = np.bincount(feature, times[kind], len(code)) >= RARE
    kind, feature = kind[common[feature]], feature[common[feature]]
    beside = np.flatnonzero(times >= NEIGHBOUR)
    beside = beside[beside > 0]
    chains, words = Chains(ids), ids != 0
    follows = words[1:] & words[:-1]

    # Weights in one vector: bias, start, three steps, word features, left and right neighbours.
    head, n, b = 5, len(code), len(beside)
    weights, squares = np.zeros(head + n + 2 * b), np.full(head + n + 2 * b, 1e-6)
    truth = np.zeros((2, 2))
    np.add.at(truth, (y[:-1][follows].astype(int), y[1:][follows].astype(int)), 1)
    first = chains.starts
    for _ in range(ROUNDS):
        bias, start, step = weights[0], weights[1], np.array([[0, weights[2]], [weights[3], weights[4]]])
        own = np.bincount(kind, weights[head + feature], kinds) + bias
        left, right = np.zeros(kinds), np.zeros(kinds)
        left[beside], right[beside] = weights[head + n : head + n + b], weights[head + n + b :]
        e = own[ids]
        e[1:] += left[ids[:-1]]
        e[:-1] += right[ids[1:]]
        forward, backward = chains.forward(e, start, step), chains.backward(e, step)
        p = 1 / (1 + np.exp(-np.clip(forward + backward, -50, 50)))
        miss = np.where(words, y - p, 0.0)
        # Expected steps between labels, from what stands before and after each pair of places.
        f, g = forward[:-1][follows], (e + backward)[1:][follows]
        cells = np.array([np.zeros_like(f), step[0, 1] + g, step[1, 0] + f, step[1, 1] + f + g])
        cells = np.exp(cells - cells.max(0))
        expected = (cells / cells.sum(0)).sum(1).reshape(2, 2)
        by_kind = np.bincount(ids, miss, kinds)
        after = np.bincount(ids[:-1], miss[1:], kinds)[beside]
        before = np.bincount(ids[1:], miss[:-1], kinds)[beside]
        slope = np.concatenate(
            [
                [by_kind[1:].sum(), miss[first].sum()],
                (truth - expected).ravel()[1:],
                np.bincount(feature, by_kind[kind], n),
                after,
                before,
            ]
        )
        slope -= PENALTY * weights
        squares += slope * slope
        weights += RATE * slope / np.sqrt(squares)
    name, word = list(code), list(number)
    kept = lambda names, part: {k: float(v) for k, v in zip(names, part) if abs(v) >= LEAST_WEIGHT}
    near = [word[i - 1].lower() for i in beside]
    return Field(
        kept(name, weights[head : head + n]),
        kept(near, weights[head + n : head + n + b]),
        kept(near, weights[head + n + b :]),
        float(weights[0]),
        float(weights[1]),
        np.array([[0, weights[2]], [weights[3], weights[4]]]),
    )


def fit_score(model: Field, texts: list[str], toxic: list[int], share: float) -> Field:
    """The field with the weights of a document's score, by logistic regression; ``share`` of all labels are toxic."""
    found = [(most, np.log1p(total)) for most, total, _ in tag_texts(Tagger(model), iter(texts))]
    x = np.column_stack([np.ones(len(texts)), np.array(found)])
    y = np.array(toxic, np.float64)
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 1e-2 * w
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(3)
        move = np.linalg.solve(curve, slope)
        w = w + move / max(1.0, np.abs(move).max())
    # More evidence never lowers a score.
    model.score = (float(w[0]), max(0.0, float(w[1])), max(0.0, float(w[2])))
    return model


def fit(texts: list[str], toxic: list[int], share: float) -> Field:
    """A model of labelled texts: half of them label words and fit the field, the other half fit the score."""
    kept = _different(texts)
    texts, toxic = [texts[i] for i in kept], [toxic[i] for i in kept]
    half = [[i for i in range(len(texts)) if i % 2 == part] for part in (0, 1)]
    if any(len({toxic[i] for i in part}) < 2 for part in half):
        half = [list(range(len(texts)))] * 2  # too few for two halves
    if len(set(toxic)) < 2:
        # One label, or none: its share is all that is known.
        p = min(max(share, 1e-6), 1 - 1e-6)
        return Field(score=(float(_logit(np.array(p))), 0.0, 0.0))
    # Every word is one string, however often it stands in the sample.
    once: dict[str, str] = {}
    tokens = [[once.setdefault(w, w) for w in _TOKEN.findall(texts[i])] for i in half[0]]
    small = {w: once.get(w.lower(), w.lower()) if w[0] not in _ENDS else "\n" for w in once}
    low = [[small[w] for w in words] for words in tokens]
    labels = label_words(low, [toxic[i] for i in half[0]])
    labels = [part & np.array([w != "\n" for w in words], bool) for part, words in zip(labels, low)]
    del low
    model = fit_field(tokens, labels)
    return fit_score(model, [texts[i] for i in half[1]], [toxic[i] for i in half[1]], share)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Field:
    """A model of a bounded sample of the labelled documents outside fold 0 (``doc_id, text``; ``doc_id, toxic``).

    A document that is labelled both ways is left out; repeated labels count once.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id")
    known = known.agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("other"))
    known = cut(known.filter((F.col("toxic") == F.col("other")) & (fold(F.col("doc_id")) != 0)).drop("other"), "labels")
    number = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = number.get(1, 0) / max(1, sum(number.values()))
    by_hash = lambda *more: [F.xxhash64("doc_id"), "doc_id", *more]
    ids = [known.filter(F.col("toxic") == k).orderBy(*by_hash()).limit(SPARE * rows) for k in (0, 1)]
    ids = F.broadcast(cut(ids[0].unionByName(ids[1]), "sample-ids"))  # at most 2 x SPARE x rows
    texts = docs.select(F.col("doc_id"), "text").filter(F.octet_length("text").between(1, SAMPLE_TEXT))
    texts = cut(texts.join(ids, "doc_id"), "sample-texts")
    found = []
    for k in (0, 1):
        part = texts.filter(F.col("toxic") == k).orderBy(*by_hash("text")).limit(rows)
        found += [(r["h"], r["text"], k) for r in part.select(F.xxhash64("doc_id").alias("h"), "text").collect()]
    found.sort()
    return fit([text for _, text, _ in found], [k for _, _, k in found], share)


def _scored(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model.value)
        span = pa.struct({"start": pa.int32(), "end": pa.int32(), "p": pa.float64()})
        for batch in batches:
            scores, spans = [], []
            for most, total, found in tag_texts(tagger, (t.as_py() or "" for t in batch.column("text"))):
                scores.append(document_score(model.value, most, total))
                spans.append([dict(zip(("start", "end", "p"), s)) for s in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))],
                ["doc_id", "score", "spans"],
            )

    return run


def score_documents(docs: DataFrame, model: Field) -> DataFrame:
    """Scores of whole texts under a model: ``doc_id, score, spans``.

    Words carry labels clean and toxic in a linear chain that ends with a sentence. Forward and backward passes give
    each word's marginal; words at ``TAGGED`` or more are spans (``start, end, p`` in code points, end exclusive,
    neighbours merged), and the score comes from the strongest word and the expected number of tagged words.

    Null and empty texts, and texts without a word, get the score of no evidence and no span. Every row is scored,
    repeated ones alike, whatever its id. An empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(
        _scored(model), "doc_id long, score double, spans array<struct<start: int, end: int, p: double>>"
    )


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Fits a model on labels outside fold 0 and scores every document: ``doc_id, held_out, score, predicted, spans``.

    ``held_out`` tells whether the id's CRC-32 modulo 5 is 0; a null id is not held out, and never labelled. Cases as in
    :func:`train` and :func:`score_documents`. Without labels of both kinds every score is the share of toxic ones.
    """
    scored = score_documents(docs, train(docs, labels, rows))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )
