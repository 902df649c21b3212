"""Targets against plain water filling, copies against their rates."""

import pytest

from lotwise.llm import mixing

SCHEMA = "doc_id long, text string, source string, target string"


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left = {}, set(order)
    rest = share * sum(sizes.values())
    while left:
        price = rest / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * price > most * sizes[s]}
        if not over:
            target |= {s: weight[s] * price for s in left}
            break
        for s in over:
            target[s] = most * sizes[s]
            rest -= target[s]
        left -= over
    return target


def documents():
    out = []
    for i in range(900):
        source = "big" if i % 3 == 0 else f"s{i % 17}" if i % 17 else None
        out.append((i, "word " * (i % 40) + "\tx y", source, "clash"))
    return out + [(None, "a b c", "é", ""), (5000, None, "empty", ""), (5001, "", "Z", None), (5, out[5][1], "s5", "")]


def test_plan(spark):
    data = documents()
    sizes = {}
    for _, text, source, _ in data:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    targets = plain_targets(sizes)
    frame = spark.createDataFrame(data, SCHEMA)
    plan = mixing.mix_plan(frame).collect()
    assert len(plan) == len(data)
    by_size = {(s, round(targets[k], 6)) for k, s in sizes.items()}
    assert {(r.source_size, round(r.target, 6)) for r in plan} == by_size
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for r in plan:
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.copies <= int(rate) + 1 and r.copies <= 2
    big = [r for r in plan if r.source_size == sizes["big"]]
    assert sum(r.size * r.copies for r in big) == pytest.approx(targets["big"], rel=0.1)
    again = mixing.mix_plan(frame.repartition(7)).collect()
    assert sorted(map(tuple, plan), key=repr) == sorted(map(tuple, again), key=repr)


def test_every_source_comes_near_its_target(spark):
    """Sources of many documents of one size: within four deviations of the draw, whatever their rate."""
    data = [(i, "one two three", f"s{i % 7}" if i % 3 else "big", "") for i in range(9000)]
    plan = mixing.mix_plan(spark.createDataFrame(data, SCHEMA)).collect()
    found = {}
    for r in plan:
        found.setdefault((r.source_size, r.target), []).append(r.size * r.copies)
    for (size, target), taken in found.items():
        n, part = len(taken), target / size % 1
        assert abs(sum(taken) - target * n * 3 / size) <= 4 * 3 * (n * part * (1 - part)) ** 0.5 + 1e-6


def test_names_of_columns(spark):
    named = "doc_id long, text string, source string, `a.b` string, copies int, `__copies` int, target string"
    frame = spark.createDataFrame([(i, "a b c", f"s{i % 3}", "x", 1, 2, "t") for i in range(30)], named)
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns and {tuple(r)[3:] for r in mixed.collect()} == {("x", 1, 2, "t")}


def test_very_long_text(spark):
    frame = spark.createDataFrame([(1, "word " * 300_000, "a", ""), (2, "x", "b", "")], SCHEMA)
    assert {r.doc_id: r["size"] for r in mixing.mix_plan(frame).collect()} == {1: 300_000, 2: 1}


@pytest.mark.parametrize("bound", [8 << 20, -1])
def test_mix_emits_the_plan(spark, monkeypatch, bound):
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", bound)
    frame = spark.createDataFrame(documents(), SCHEMA)
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    want = {}
    for r in mixing.mix_plan(frame).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    assert got == {k: n for k, n in want.items() if n}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_plan(empty).count() == 0 and mixing.mix(empty).count() == 0
    zero = spark.createDataFrame([(1, "", "a", "")], SCHEMA)
    assert [(r.target, r.copies) for r in mixing.mix_plan(zero).collect()] == [(0.0, 0)]
