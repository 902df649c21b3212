"""Base columns against plain counts; rules at their bounds."""

import re

import numpy as np
from pyspark.sql import functions as F

from lotwise.llm import quality

SCHEMA = "doc_id long, text string, kept string"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(p + k for p in places for k in range(8))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def texts():
    rng = np.random.default_rng(2)
    out = ["", None, " \n\t", "é😀 #a|b c <x>", "one\n one\none\n\n\none ", "a " * 300, "a b " * 4 + "c"]
    for n in (7, 8, 9, 30, 200):
        out.append(" ".join(rng.choice([f"w{i}" for i in range(5)], n)))
        line = " ".join(rng.choice([f"v{i}" for i in range(900)], n))
        out += [line + "\n" + line, line + " x " + line[:40]]
    return out


def test_base_equals_plain(spark):
    rows = [(i, t, "clash") for i, t in enumerate(texts())] + [(None, texts()[5], ""), (6, texts()[6], "")]
    got = quality.quality_rules(spark.createDataFrame(rows, SCHEMA)).select("doc_id", *BASE, "base_failed").collect()
    want = []
    for i, text, _ in rows:
        base = plain(text)
        want.append((i, *base, base[0] < 20 or 100 * base[4] > 30 * base[0]))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_rules(spark):
    clean = "the words of a text that is fine and to be kept for what it is " * 1
    clean += " ".join(f"word{i}" for i in range(60))
    rows = [(1, clean), (2, clean + " #" * 25), (3, " ".join(f"word{i}" for i in range(60))), (4, "- " + clean)]
    out = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.failed_rules for r in out.collect()} == {1: [], 2: ["symbols"], 3: ["stop_words"], 4: ["bullet_lines"]}
    assert {r.doc_id for r in out.filter("kept").collect()} == {1}
    assert quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"), ()).filter("kept").count() == 4


def test_texts_without_words(spark):
    """Verdicts of every rule exist where ratios have no denominator."""
    rows = [(i, t, "") for i, t in enumerate([None, "", " \n\t", "\n", "word", "the", "#"])]
    got = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(r.base_failed and not r.kept for r in got.values())
    assert [got[i].failed_rules for i in range(4)] == [[]] * 4
    assert got[4].failed_rules == ["stop_words"] and got[5].failed_rules == []
    assert got[6].failed_rules == ["word_length", "symbols", "stop_words"]


def test_stop_words_as_written_in_prose(spark):
    rows = [(0, "The. Of, And; \"IS\" (für) ¿Más? Los! ÜBER"), (1, "them. off andy this-one")]
    stats = quality.text_stats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_stop_words for r in stats} == {0: 7, 1: 0}


def test_very_long_text_and_names(spark):
    """A text of many words, and columns with the names of the operator's own."""
    words = [f"w{i % 20_011} the" for i in range(200_000)]
    frame = spark.createDataFrame([(1, " ".join(words), "x", 2)], "doc_id long, text string, `__words` string, `a.b` int")
    row = quality.quality_rules(frame).first()
    assert (row.n_words, row.n_repeat_words) == plain(" ".join(words))[::4] and (row["__words"], row["a.b"]) == ("x", 2)


def test_no_user_functions_in_the_plan(spark):
    plan = quality.quality_rules(spark.range(1).withColumn("text", F.lit("x")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert quality.quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0


def test_kept_documents(spark):
    """The kept rows as they were, their own columns included, and the words of a text computed once."""
    rows = [(i, " ".join(f"the{i} of word{k}" for k in range(9 + i)), "x" * i) for i in range(-4, 4)] + [(9, None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    out = quality.kept_documents(frame)
    good = {r.doc_id for r in quality.quality_rules(frame).filter("kept").collect()}
    assert good and out.columns == frame.columns
    assert sorted(map(tuple, out.collect())) == sorted(r for r in rows if r[0] in good)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^\\x20\\x09-\\x0D]+, 0)") == 1
