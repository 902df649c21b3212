"""Collocations against plain counts, border failures included."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from lotwise.llm import phrases

SCHEMA = "doc_id long, text string, lang string, n string, phrase string"


def plain(rows, least=100, top=2000):
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i : i + k])] += 1
    out = {}
    for (lang, p), a in f.items():
        if a < least or len(p) < 2:
            continue
        inside = any(
            f[lang, q] >= least and f[lang, q] >= a
            for (other, q) in f
            if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        )
        if not inside:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    rows = []
    for lang, found in out.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(rows)


def documents():
    rng = np.random.default_rng(12)
    word = [f"w{i}" for i in range(25)]
    out = []
    for i in range(160):
        words = list(rng.choice(word, rng.integers(1, 50)))
        for at in sorted(rng.integers(0, len(words) + 1, 3)):
            words[at:at] = rng.choice(["New York", "new york city hall", "Ünder the  bridge", "a a a a a a", "x. y"]).split(" ")
        marks = rng.choice([" ", " ", " ", " ", "\t", ", ", ".", "\n", " \r", "\x0b", " "], len(words))
        out.append((i, "".join(w + m for w, m in zip(words, marks)), ["en", "de", None, "und"][i % 4], "", "clash"))
    odd = [None, "", " \t", "...", "one", "\n\n", "a" * 3000]
    return out + [(500 + i, t, "en", None, None) for i, t in enumerate(odd)] + [out[0], out[0], (None, out[1][1], "xx", "", "")]


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = phrases.collocations(frame, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("least,top", [(8, 2000), (12, 5)])
def test_equals_plain(spark, least, top):
    want = plain(documents(), least, top)
    assert len({r[0] for r in want}) >= 3 and len(want) > 10
    assert found(spark, documents(), least=least, top=top) == want


def test_in_parts(spark, monkeypatch):
    """Texts in small parts, blocks of few words, counts that are sent on all the time."""
    for name, value in {"PART_CHARS": 40, "BLOCK_BYTES": 200, "HELD_HASHES": 20, "HELD_PHRASES": 5}.items():
        monkeypatch.setattr(phrases, name, value)
    assert found(spark, documents(), least=8) == plain(documents(), 8)


def test_full_filters(spark, monkeypatch):
    """Filters so small that they let much through: more is counted, nothing else changes."""
    monkeypatch.setattr(phrases, "MOST_BITS", 1 << 4)
    monkeypatch.setattr(phrases.Filter, "has", lambda self, hashes: np.ones(len(hashes), bool))
    assert found(spark, documents(), least=8) == plain(documents(), 8)


def test_streams(monkeypatch):
    """Words and phrases of a run of bytes, cut into parts at will."""
    rows = [("en", r[1]) for r in documents() if r[1]]
    for part, block in ((1 << 20, 1 << 20), (30, 100), (7, 1)):
        monkeypatch.setattr(phrases, "PART_CHARS", part)
        monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
        got = Counter()
        for stream in phrases._streams(iter(rows)):
            for k, value, whole, fresh in stream.grams():
                assert not (fresh & ~whole).any()
                got.update((k, stream.phrase(i, k).decode(), int(value[i])) for i in np.flatnonzero(fresh).tolist())
        names = Counter()
        for (k, phrase, _), n in got.items():
            names[phrase] += n
        want = Counter()
        for _, text in rows:
            low = "".join(c.lower() if c.isascii() else c for c in text)
            for piece in re.split("[.,;:!?\x0a-\x0d]", low):
                w = re.findall("[^\x20\x09]+", piece)
                want.update(" ".join(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
        assert names == want and len(got) == len(want)  # one hash for each phrase


def test_counts_are_cut_but_decide_alike():
    rng = np.random.default_rng(1)
    counts, want = phrases.Counts(4, 100), Counter()
    packs = []
    for _ in range(5):
        hashes = rng.integers(0, 1 << 63, 40, dtype=np.uint64)[rng.integers(0, 40, 900)] * np.uint64(2)
        hashes = np.concatenate([hashes, np.full(300, 1 << 62, np.uint64)])
        counts.add(2, hashes)
        want.update(hashes.tolist())
        packs.append(counts.sent().to_pandas())
    rows = pd.concat(packs)
    assert len(set(rows["bucket"])) == 4
    found = [phrases._totals(None, 100)(part) for _, part in rows.groupby("bucket")]
    got = set(pd.concat(found)["hash"].to_numpy(np.int64).view(np.uint64).tolist())
    assert got == {h for h, n in want.items() if n >= 100} and 1 << 62 in got


def test_border_failures(spark):
    """A sample of next to nothing proposes no phrase: all are found by the pass over the borders that failures open."""
    rows = documents()
    frame = spark.createDataFrame(rows, SCHEMA).filter("text IS NOT NULL").selectExpr("coalesce(lang, 'und') lang", "text", "xxhash64(doc_id, text) draw")
    _, passes = phrases.frequent_filters(frame, 8, 1e-6)
    assert passes == 3  # words, pairs, and one pass for all that the failures open
    assert found(spark, rows, least=8, sample=1e-6) == plain(rows, 8)
    assert found(spark, rows, least=8, sample=0.05) == plain(rows, 8)
    _, passes = phrases.frequent_filters(frame, 8, 1.0)
    assert passes == 2


def test_large_counts(spark):
    """Products past 64 bits."""
    left = spark.createDataFrame([(3_000_000_000, 9_000_000_000_000, 4_000_000_000, 5_000_000_000)], "a long, n long, l long, r long")
    wide = "cast({} as decimal(19,0))".format
    over = f"cast({wide('a')} * 1000 as decimal(19,0)) * {wide('n')}"
    assert left.selectExpr(f"({over}) div ({wide('l')} * {wide('r')}) s").first().s == 1_350_000


def test_empty_table(spark):
    assert found(spark, []) == [] and found(spark, [(1, None, "en", "", "")]) == []
