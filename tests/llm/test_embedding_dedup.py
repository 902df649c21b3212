"""Links and groups against all pairs."""

import math

import numpy as np
import pytest

from lotwise.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, copies string"


def plain(rows, least=0.9):
    vectors = [np.array(v, np.float64) if v and None not in v else None for _, v, *_ in rows]
    vectors = [v if v is not None and np.isfinite(v).all() and v.any() else None for v in vectors]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors[:i]):
            if a is not None and b is not None and len(a) == len(b):
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= least:
                    links[i] += 1
                    links[j] += 1
                    lo, hi = sorted((find(i), find(j)))
                    root[hi] = lo
    smallest = {}
    for i, (vec, *_) in enumerate(rows):
        if vec is not None:
            smallest[find(i)] = min(vec, smallest.get(find(i), vec))
    return [(r[0], links[i], smallest.get(find(i)), r[0] == smallest.get(find(i))) for i, r in enumerate(rows)]


def rows():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16))
    out = [v for v in base]
    for v in base[:20]:
        for angle in (0.05, 0.3, 0.44, 0.5):
            turn = rng.standard_normal(16)
            turn -= turn @ v / (v @ v) * v
            out.append((v * math.cos(angle) + turn / np.linalg.norm(turn) * np.linalg.norm(v) * math.sin(angle)) * 3)
    out = [[float(np.float32(x)) for x in v] for v in out]
    out += [out[3]] * 6
    rows = [(1000 - i, v, 1, "clash") for i, v in enumerate(out)]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.1]]
    return rows + [(2000 + i, v, None, None) for i, v in enumerate(odd)] + [(None, out[5], 1, ""), (996, out[4], 1, "")]


def found(spark, data):
    got = ed.near_duplicates(spark.createDataFrame(data, SCHEMA)).collect()
    return sorted(map(tuple, got), key=repr)


def test_equals_all_pairs(spark):
    assert found(spark, rows()) == sorted(plain(rows()), key=repr)


def test_small_blocks(spark, monkeypatch):
    """Many blocks and chunks per list, few queries, codes and candidates at once."""
    small = {"MEMBERS": 5, "VECTOR_BYTES": 900, "CODE_BYTES": 700, "QUERIES": 3, "CODES": 4, "PAIRS": 4}
    for name, value in small.items():
        monkeypatch.setattr(ed, name, value)
    assert found(spark, rows()) == sorted(plain(rows()), key=repr)


def test_empty_table(spark):
    assert found(spark, []) == []


def close_pairs(rng, n, size, cosine):
    x = ed._unit(rng.standard_normal((n, size)))
    turn = rng.standard_normal((n, size))
    turn -= (turn * x).sum(1, keepdims=True) * x
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    return x, cosine * x + math.sqrt(1 - cosine**2) * turn


@pytest.mark.parametrize("size", [64, 24, 7])
@pytest.mark.parametrize("groups", [0, 40])
def test_no_pair_is_lost(size, groups):
    """Outside the sample, with and without structure: pairs at the least cosine meet and stay candidates."""
    rng = np.random.default_rng(11)
    x, y = close_pairs(rng, 3000, size, 0.9001)
    if groups:
        near = ed._unit(rng.standard_normal((groups, size)))[rng.integers(0, groups, 3000)]
        x = ed._unit(near + 0.3 * x / math.sqrt(size))
        y = ed._unit(x + 0.2 * y)
    x, y = x[(x * y).sum(1) >= 0.9], y[(x * y).sum(1) >= 0.9]
    index = ed.Index.fit(ed._unit(x[: len(x) // 3] + 1e-3), 2 * len(x), 0.9)
    lists = [list(index.visits(v)) for v in (x, y)]
    homes = [np.array([v[0] for v in found]) for found in lists]
    assert all((h[1] in a[1:]) + (h[0] in b[1:]) + (h[0] == h[1]) == 1 for a, b, h in zip(*lists, zip(*homes)))
    for one, other, home in ((x, y, homes[1]), (y, x, homes[0])):
        codes, error = index.coded(other, home)
        assert codes.shape == (len(x), -(-size // 4)) and error.max() < 1.2
        for at in range(0, len(x), 50):
            part = slice(at, at + 50)
            near = index.candidates(one[part], home[part], codes[part], error[part], 0.9)
            assert near.diagonal().all()


def test_table_sums_are_products_with_decoded_codes():
    rng = np.random.default_rng(2)
    x = ed._unit(rng.standard_normal((2000, 30)))
    index = ed.Index.fit(x[:1000], len(x), 0.9)
    home = ed._nearest(x, index.lists)
    codes, error = index.coded(x, home)
    decoded = index.lists[home] + np.concatenate([index.books[s][codes[:, s]] for s in range(8)], axis=1)[:, :30]
    assert np.allclose(np.linalg.norm(x - decoded, axis=1), error, atol=1e-5)
    centres, words = index.tables(x[:5])
    sums = centres[home] + sum(words[s][codes[:, s]] for s in range(8))
    assert np.allclose(sums * ed.STEP, decoded @ x[:5].T, atol=5 * ed.STEP)
    # Most codes are ruled out, though the vectors have no structure.
    assert index.candidates(x[:50], home, codes, error, 0.9).mean() < 0.1


def test_lengths_in_one_plan(spark, monkeypatch):
    """More lengths than there are indexes for."""
    monkeypatch.setattr(ed, "LENGTHS", 2)
    rng = np.random.default_rng(4)
    data = []
    for size in range(1, 9):
        for v in rng.standard_normal((12, size)):
            data.append((len(data), [float(np.float32(x)) for x in v], 0, ""))
    assert found(spark, data) == sorted(plain(data), key=repr)


def test_doubles(spark):
    rng = np.random.default_rng(8)
    x, y = close_pairs(rng, 40, 12, 0.95)
    data = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    got = ed.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(data), key=repr)


def test_all_links_outside_the_sample(spark, monkeypatch):
    """Neighbours along the data's own directions, nearly all outside the sample, against all pairs."""
    monkeypatch.setattr(ed, "SAMPLE_ROWS", 512)
    monkeypatch.setattr(ed, "MEMBERS", 100)
    rng = np.random.default_rng(5)
    spread = rng.standard_normal((12, 64))
    hidden = rng.standard_normal((3000, 12))
    near = hidden + 0.33 * rng.standard_normal(hidden.shape)
    x = np.concatenate([hidden, near]) @ spread + 0.05 * rng.standard_normal((6000, 64))
    x = x.astype(np.float32)
    unit = ed._unit(x.astype(np.float64))
    links = (unit @ unit.T >= 0.9).sum(1) - 1
    data = spark.createDataFrame([(i, v.tolist(), None, None) for i, v in enumerate(x)], SCHEMA)
    got = {r.vec_id: r.n_links for r in ed.near_duplicates(data).collect()}
    assert sum(links) > 4000 and got == dict(enumerate(links.tolist()))


def test_lists_are_left_out_where_none_can_hold_a_neighbour():
    """Groups far apart: the bound leaves few lists, and each pair of neighbours meets in one of them."""
    rng = np.random.default_rng(6)
    x = ed._unit(np.repeat(rng.standard_normal((40, 64)), 150, axis=0) + 0.25 * rng.standard_normal((6000, 64)))
    index = ed.Index.fit(x[::7], len(x), 0.9)
    lists = list(index.visits(x))
    assert len(index.lists) > 8 and np.mean([len(v) for v in lists]) < len(index.lists) / 4
    meets = np.zeros((len(x), len(index.lists)), bool)
    for row, some in zip(meets, lists):
        row[some[1:]] = True
    i, j = np.nonzero(np.triu(x @ x.T >= 0.9, 1))
    home = np.array([v[0] for v in lists])
    met = (home[i] == home[j]).astype(int) + meets[i, home[j]] + meets[j, home[i]]
    assert len(i) > 1000 and (met == 1).all()
