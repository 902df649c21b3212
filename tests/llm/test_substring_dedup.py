"""Removed words against a plain search over all windows."""

import hashlib
import itertools

import numpy as np
import pytest

from lotwise.llm import substring_dedup as sd

SCHEMA = "doc_id long, text string, key string"


def plain(rows):
    """Rows equal in id and text are one document; ids order documents, null last."""
    split = lambda t: [w for w in (t or "").encode().split()]
    key = lambda r: (r[0] is None, r[0] or 0)
    documents = sorted({r[:2] for r in rows}, key=key)
    seen, removed = {}, {}
    for doc in documents:
        words = split(doc[1])
        for i in range(len(words) - 19):
            if tuple(words[i : i + 20]) in seen:
                removed.setdefault(doc, set()).update(range(i, i + 20))
            else:
                seen[tuple(words[i : i + 20])] = doc
    out = []
    for doc, text, _ in rows:
        words = split(text)
        gone = removed.get((doc, text), set())
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=repr)


def rows():
    rng = np.random.default_rng(9)
    word = [f"w{i}é" if i % 5 == 0 else f"W{i}" for i in range(500)]
    passages = [list(rng.choice(word, n)) for n in (19, 20, 21, 33, 60, 150)]
    out = [(7, None, ""), (8, "", ""), (9, " \n ", ""), (10, "only a few words", "")]
    for i in range(60):
        text = list(rng.choice(word, rng.integers(0, 90)))
        for _ in range(rng.integers(0, 4)):
            passage = passages[rng.integers(len(passages))]
            cut = passage[rng.integers(0, 8) :]
            at = rng.integers(0, len(text) + 1)
            text = text[:at] + cut + text[at:]
        out.append((200 - i, "\n ".join(text) if i % 2 else " ".join(text), "clash"))
    long = " ".join(passages[5])
    out += [(3, long, ""), (300, long + " " + long, ""), (301, "a " * 100, ""), (2, "a " * 30, "")]
    out += [(None, long + " end", ""), (300, long + " " + long, ""), (199, out[5][1], ""), (400, out[30][1], "")]
    return out


def found(frame):
    digests = sd.repeat_digests(frame).collect()
    texts = sd.remove_repeats(frame).collect()
    assert sorted((hashlib.sha256(r.text.encode()).hexdigest() for r in texts)) == sorted(r.kept_sha256 for r in digests)
    return sorted(map(tuple, digests), key=repr)


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_equals_plain(spark, monkeypatch, block):
    monkeypatch.setattr(sd, "BLOCK_BYTES", block)
    data = rows()
    assert found(spark.createDataFrame(data, SCHEMA).repartition(5)) == [r[:4] for r in plain(data)]


def test_empty_table(spark):
    assert sd.repeat_digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cover():
    """Any two places are on the cover together after a shift that keeps the anchor in the window."""
    assert sd.PERIOD - 1 + sd.ANCHOR <= sd.WINDOW
    for i, j in itertools.product(range(sd.PERIOD), repeat=2):
        assert any(
            (i + s) % sd.PERIOD in sd.COVER and (j + s) % sd.PERIOD in sd.COVER for s in range(sd.PERIOD)
        )


def test_run_hashes():
    hashes = sd.WordHashes()
    words = hashes.words("a b c a b d a b c a b d")
    runs = hashes.runs(words, 3)
    assert len(runs) == 10 and runs[0] == runs[6] and runs[3] == runs[9] and len(set(runs.tolist())) == 6
    assert set(runs.tolist()).isdisjoint(hashes.runs(words, 3, salt=1).tolist())


def test_buckets_follow_the_input(spark, tmp_path, monkeypatch):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    least = sd._bucket_count(docs)
    size = sum(f.stat().st_size for f in (tmp_path / "docs").glob("*.parquet"))
    monkeypatch.setattr(sd, "BUCKET_BYTES", size // (4 * least))
    assert sd._bucket_count(docs) >= 4 * least
    assert found(docs) == [r[:4] for r in plain(rows())]


def test_marks_of_blocks_are_groups_of_their_own(spark):
    """A passage that every document holds reaches its buckets once per block."""
    passage = " ".join(f"p{i}" for i in range(40))
    docs = spark.createDataFrame([(i, passage, "") for i in range(400)], SCHEMA).repartition(12)
    made = docs.selectExpr("doc_id AS key", "text").mapInArrow(
        sd._bucketed(4), "group long, bucket int, known boolean, keys binary, runs binary, names binary"
    )
    made = made.toPandas()
    blocks = made.loc[made.known, "group"].nunique()
    sent = made[~made.known].groupby("group")["names"].apply(lambda x: sum(map(len, x)) // 4)
    anchors = 4 * (40 - sd.ANCHOR + 1) // sd.PERIOD + 1
    assert blocks == 12 and set(made.loc[~made.known, "group"]) <= set(range(4)) and sent.sum() <= anchors * blocks
    assert (made.loc[made.known, "group"] < 0).all() and made[made.known].groupby("group").size().max() <= 4
