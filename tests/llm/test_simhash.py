"""Fingerprints, links and groups against brute force."""

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from lotwise.llm import simhash
from lotwise.llm.components import components

SCHEMA = "doc_id long, text string, print string"


def plain_print(text):
    words = ["".join(c.lower() if c.isascii() else c for c in w) for w in (text or "").encode().decode().split()]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


WORDS = [f"w{i}" for i in range(300)]


def texts():
    rng = np.random.default_rng(5)
    base = [" ".join(rng.choice(WORDS, 200)) for _ in range(12)]
    out = ["", None, "  \n", "One", "one", "two words", "Three little words", "now Four Words here", "Äb äb"]
    for text in base:
        words = text.split()
        out.append(text)
        for n in (1, 2, 5):
            changed = list(words)
            for i in rng.integers(0, len(words), n):
                changed[i] = "NEW"
            out.append(" ".join(changed))
    return out + [base[0]] * 5


def test_fingerprint():
    for text in texts():
        assert simhash.fingerprint(text) == plain_print(text)


def test_fingerprint_in_parts(monkeypatch):
    want = [simhash.fingerprint(t) for t in texts()]
    monkeypatch.setattr(simhash.text_parts, "__defaults__", (10,))
    monkeypatch.setattr(simhash, "HASHES", 7)
    assert [simhash.fingerprint(t) for t in texts()] == want


def test_groups(spark):
    rows = [(1000 - i, t, "clash") for i, t in enumerate(texts())] + [(None, "one", ""), (990, texts()[10], "")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = [plain_print(t) for _, t, _ in rows]
    groups = plain_groups(prints)
    least = {}
    for (doc, _, _), g in zip(rows, groups):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    want = [(r[0], p, least[g]) for r, p, g in zip(rows, prints, groups)]
    found = [(r.doc_id, r.print & (1 << 64) - 1, r.component_id) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "print"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_null_ids_alone(spark):
    docs = spark.createDataFrame([(None, "a b c d e", ""), (None, "a b c d e", ""), (None, "x", "")], SCHEMA)
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {None}
    assert sorted(r.text for r in simhash.keep_one(docs).collect()) == ["a b c d e", "x"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0 and simhash.keep_one(docs).count() == 0


def near_prints(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 64, n, dtype=np.uint64)
    flips = [base]
    for k in (1, 3, 4, 5, 6):
        mask = np.zeros(n, np.uint64)
        for row in range(n):
            for bit in rng.choice(64, k, replace=False):
                mask[row] |= np.uint64(1) << np.uint64(bit)
        flips.append(base ^ mask)
    return np.unique(np.concatenate(flips))


@pytest.mark.parametrize("leaf,front", [(8, 1 << 18), (1, 5)])
def test_trie_join(monkeypatch, leaf, front):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    monkeypatch.setattr(simhash, "FRONT", front)
    values = near_prints(60, 1)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    want = {(i, j) for i, j in zip(*np.nonzero(near)) if i < j}
    found = [(int(i), int(j)) for x, y in simhash.linked_pairs(values, None, 4) for i, j in zip(x, y)]
    assert len(found) == len(set(found)) and set(found) == want
    a, b = values[::2], values[1::2]
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= 4
    found = [(int(i), int(j)) for x, y in simhash.linked_pairs(a, b, 4) for i, j in zip(x, y)]
    assert len(found) == len(set(found)) and set(found) == set(zip(*map(np.ndarray.tolist, np.nonzero(near))))


@pytest.mark.parametrize("node_rows", [1 << 15, 10, 0.02])
def test_split_over_tasks(spark, node_rows):
    """One node, nodes inside a block of bits, and nodes below it."""
    values = near_prints(40, 2)
    rows = spark.createDataFrame([(v,) for v in values.view(np.int64).tolist()], "print long")
    links = simhash.print_links(rows, 4, node_rows=node_rows)
    found = {r.node: r.root for r in components(links).collect()}
    groups = plain_groups(values.tolist())
    signed = values.view(np.int64).tolist()
    of = {}
    for v, g in zip(signed, groups):
        of.setdefault(g, []).append(v)
    for members in of.values():
        assert {found.get(v, v) for v in members} == {min(members)}


def test_copies_do_not_grow_with_the_table(spark):
    """Five copies of a fingerprint at any depth inside a block: at 32 thousand of them, and at 100 million."""
    prints = spark.createDataFrame([(v,) for v in near_prints(40, 3).view(np.int64).tolist()], "print long")
    n = prints.count()
    for rows in (1, 1 << 15, 1 << 20, 100_000_000):
        assert simhash.trie_nodes(prints, rows).count() == 5 * n
    assert sum(width for _, width in simhash._turns(4)) == 64 and min(width for _, width in simhash._turns(4)) >= 12


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
@settings(max_examples=5, deadline=None)
def test_components(spark, links):
    root = {n: n for pair in links for n in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    linked = {n for a, b in links if a != b for n in (a, b)}
    frame = spark.createDataFrame([*links, (None, 3)], "a int, b int")
    assert {r.node: r.root for r in components(frame).collect()} == {n: root[n] for n in linked}


def test_keep_one_by_group(spark):
    """An id in two unrelated groups loses neither; a group of null ids alone keeps one row over its fingerprints."""
    one, two, other = ("a b c d e f g", "t u v w x y z", "k l m n o p q")
    words = [f"w{i}" for i in range(400)]
    near = [" ".join(words[:n]) for n in (400, 399, 397)]
    assert 1 < len({plain_print(t) for t in near}) and set(plain_groups([plain_print(t) for t in near])) == {0}
    rows = [(1, one, ""), (1, two, ""), (2, one, ""), (3, two, ""), (4, other, "")] + [(None, t, "") for t in near]
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(kept[i] for i in range(len(kept)) if kept[i][0]) == [(1, one), (1, two), (4, other)]
    assert len([t for i, t in kept if i is None and t in near]) == 1 and len(kept) == 4


def test_names_of_columns(spark):
    named = "doc_id long, text string, `__id` string, `__hash` int, `a.b` int, root int, `best_id` int"
    data = [(1, "a b c d e", "x", 1, 2, 3, 4), (2, "a b c d e", "y", 1, 2, 3, 4), (3, "other", "z", 1, 2, 3, 4)]
    got = simhash.keep_one(spark.createDataFrame(data, named))
    assert got.columns == ["doc_id", "text", "__id", "__hash", "a.b", "root", "best_id"]
    assert sorted(map(tuple, got.collect())) == [data[0], data[2]]
