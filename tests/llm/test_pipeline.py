"""Every stage against a plain version of it, on its own input."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from test_line_dedup import plain as plain_lines
from test_simhash import plain_groups, plain_print
from tokenizers import Tokenizer

import corpus_pipeline
from lotwise.llm.mixing import mix_plan

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
PATH = public_tokenizers.path("word_bpe_49k.json")


def documents():
    rng = np.random.default_rng(4)
    word = [*("the of and to in is that for".split() * 8), *(f"word{i}" for i in range(300))]
    out = []
    for i in range(60):
        text = "\n".join(" ".join(rng.choice(word, 30)) for _ in range(rng.integers(1, 5)))
        out.append([i, text + ("\nfooter of every site" if i % 2 else ""), f"s{i % 11}"])
    out += [[100, out[3][1], "s1"], [101, out[4][1] + " more", "s2"], [102, "too short", "s3"], [103, None, None]]
    out += [[104, "### $$$ %%% && " * 30, "s4"], [105, "the same of it " * 40, "s5"], [None, out[7][1] + " end", None]]
    return [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in out]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage, written and read like the pipeline does."""
    folder = str(tmp_path_factory.mktemp("stages"))
    spark.createDataFrame(documents(), COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        seen.append((docs, out))
        docs = out
    return folder, seen


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_order_and_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "mix_sources", "bpe"]
    assert all(out.columns == docs.columns for docs, out in stages[1][:-1])


def test_quality(stages):
    docs, out = stages[1][0]
    gone = {r[0] for r in rows(docs)} - {r[0] for r in rows(out)}
    assert gone == {102, 103, 104, 105}
    assert set(rows(out)) <= set(rows(docs))


def test_lines(stages):
    docs, out = stages[1][1]
    want = plain_lines([(r.doc_id, r.text, r.source, "") for r in docs.collect()], 10)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted((w[:2] for w in want), key=repr)
    assert all(r.n_chars == len(r.text) for r in out.collect()) and "footer" in out.filter("doc_id = 1").first().text
    assert out.filter("text LIKE '%footer of every site'").count() == 1


def test_one_of_each_group_stays(stages):
    docs, out = stages[1][2]
    data = docs.collect()
    groups = plain_groups([plain_print(r.text) for r in data])
    least = {}
    for r, g in zip(data, groups):
        if r.doc_id is not None:
            least[g] = min(r.doc_id, least.get(g, r.doc_id))
    assert {r.doc_id for r in out.collect()} == {least.get(g) for g in groups} and out.count() == len(set(groups))
    assert set(rows(out)) <= set(rows(docs))


def test_mix(stages):
    docs, out = stages[1][3]
    want = {r.doc_id: r.copies for r in mix_plan(docs).collect() if r.copies}
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == want and max(got.values()) <= 2 and set(rows(out)) <= set(rows(docs))


def test_tokens(stages):
    docs, out = stages[1][4]
    library = Tokenizer.from_file(PATH)
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        digests = (hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), shown.encode()))
        want.append((r.doc_id, len(ids), *digests))
    assert rows(out) == sorted(want, key=repr)


def test_run(spark, stages):
    assert rows(corpus_pipeline.run(spark, stages[0])) == rows(stages[1][4][1])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_names_of_columns(spark, tmp_path):
    """Stages carry columns of any name, and need no ``n_chars``."""
    named = "doc_id long, text string, source string, `a.b` string, row int, n_words string, `__gone` int"
    data = [(i, text, source, "x", 1, "y", 2) for i, text, _, source, _ in documents()]
    docs = spark.createDataFrame(data, named)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert {tuple(r)[3:] for r in docs.collect()} == {("x", 1, "y", 2)}
