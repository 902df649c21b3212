"""Lines on many sites against a plain count."""

import pytest

from lotwise.llm import line_dedup as ld

SCHEMA = "doc_id long, text string, source string, line_hash string"


def plain(rows, least):
    sites, home = {}, {}
    lines = lambda t: [x.strip(" \t\n\x0b\x0c\r") for x in (t or "").split("\n")]
    for doc, text, site, _ in rows:
        for line in filter(None, lines(text)):
            sites.setdefault(line, set()).add(site)
            if doc is not None:
                home[line] = min(doc, home.get(line, doc))
    out = []
    for doc, text, site, more in rows:
        if text is not None:
            keep = [
                x
                for x, line in zip(text.split("\n"), lines(text))
                if not line or len(sites[line]) < least or home.get(line) == doc
            ]
            text = "\n".join(keep)
        out.append((doc, text, site, more))
    return out


def rows():
    out = []
    for i in range(40):
        text = [f"own line {i}", "everywhere", f" on {i % 7} sevenths\t", "", f"in half {i % 2}"]
        out.append((100 - i, "\n".join(text[: 2 + i % 4] + text[1:2]), f"site{i % 14}", "clash"))
    out += [
        (200, None, "site1", ""),
        (201, "", None, ""),
        (202, "everywhere\n\n \nlast", None, ""),
        (None, "everywhere\nonly null ids", "x", ""),
        (None, "everywhere\nonly null ids", "x", ""),
        (61, "everywhere", "site0", "same id"),
    ]
    return out + [(300 + i, "only null ids?\nÉtait ici" + " " * i, None if i == 3 else f"s{i}", None) for i in range(12)]


@pytest.mark.parametrize("least", [2, 7, 10])
def test_equals_plain(spark, least):
    got = ld.line_dedup(spark.createDataFrame(rows(), SCHEMA), min_sites=least)
    assert got.columns == ["doc_id", "text", "source", "line_hash"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(rows(), least), key=repr)


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(ld, "BROADCAST_ROWS", -1)
    got = ld.line_dedup(spark.createDataFrame(rows(), SCHEMA), min_sites=7)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(rows(), 7), key=repr)


def test_sketches_of_many_sites(spark):
    """Spread far above the threshold, near it, and below it."""
    data = [(i, "wide\n" + ("near\n" if i < 300 else "") + ("under" if i < 299 else ""), f"s{i}", "") for i in range(3000)]
    found = ld.spread_lines(spark.createDataFrame(data, SCHEMA), min_sites=300)
    hashes = spark.sql("SELECT xxhash64('wide') a, xxhash64('near') b").first()
    assert {r.line_hash for r in found.collect()} == set(hashes)


def test_empty_table(spark):
    assert ld.line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_names_of_columns(spark):
    """Carried columns may have any name."""
    named = "doc_id long, text string, source string, `a.b` string, `__gone` long, row int, place int, `t``k` int"
    data = [(i, f"everywhere\nown {i}", f"s{i}", "x", i, 1, 2, 3) for i in range(12)]
    got = ld.line_dedup(spark.createDataFrame(data, named))
    assert got.columns == ["doc_id", "text", "source", "a.b", "__gone", "row", "place", "t`k"]
    want = [(i, text if i == 0 else f"own {i}", *more) for i, text, *more in data]
    assert sorted(map(tuple, got.collect())) == want


def test_long_text_without_python(spark):
    """A text with very many lines, most of them marked, in built-in functions alone."""
    many = [f"line {i}" for i in range(60_000)]
    data = [(i, "\n".join(many) if i < 2 else "\n".join(many[i::10]), f"s{i % 3}", "") for i in range(12)]
    data = [(i, text + f"\nown {i}", site, more) for i, text, site, more in data]
    out = ld.line_dedup(spark.createDataFrame(data, SCHEMA), min_sites=3)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] == data[0][1] and [got[i] for i in range(1, 12)] == [r[1] for r in sorted(plain(data, 3))[1:]]
    assert "Python" not in out._jdf.queryExecution().toString()
