"""Every registered query over whole tables, against its SQL or a plain version."""

import hashlib

import check_queries
import numpy as np
import public_tokenizers
import pytest
from test_embedding_dedup import plain as plain_vectors
from test_mixing import plain_targets
from test_pii import PLAIN, plain_base
from test_simhash import plain_groups, plain_print
from tokenizers import Tokenizer

import __spark_entry__ as entry
from lotwise.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_queries.oracle(SF)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def found(spark, name):
    return sorted(map(tuple, QUERIES[name](spark, SF).collect()))


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, con, name):
    assert check_queries.compare(spark, con, SF, name) is None


def test_bpe(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in docs:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False).encode()
        raw = np.array(ids, "<u4").tobytes()
        want.append((r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(shown).hexdigest()))
    assert found(spark, "op2_bpe") == sorted(want)


def test_embeddings(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert found(spark, "op3_embedding_dedup") == sorted(plain_vectors(rows))


def test_token_counts(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counts = [(r, len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs]
    want = [(r.doc_id, len((r.text or "").encode()), n, n > 1024) for r, n in counts]
    assert found(spark, "op4_token_counts") == sorted(want)


def test_mixing(spark, docs):
    sizes = {}
    for r in docs:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").encode().split())
    targets = plain_targets(sizes)
    by_id = {r.doc_id: r for r in docs}
    for doc_id, size, source_size, target, taken in found(spark, "op6_mix_sources"):
        source = by_id[doc_id].source
        assert size == len((by_id[doc_id].text or "").encode().split()) and source_size == sizes[source]
        assert target == pytest.approx(targets[source])
        assert taken in (size * int(target / source_size), size * (int(target / source_size) + 1)) and taken <= 2 * size


def test_pii(spark, docs):
    want = []
    for r in docs:
        spans = plain_base(r.text)
        written = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        counts = [sum(s[3] == kind for s in spans) for kind in PLAIN]
        want.append((r.doc_id, *counts, hashlib.sha256(written.encode()).hexdigest()))
    assert [row[:6] for row in found(spark, "op8_pii")] == sorted(want)


def test_simhash(spark, docs):
    prints = [plain_print(r.text) for r in docs]
    groups, least = plain_groups(prints), {}
    for r, g in zip(docs, groups):
        least[g] = min(r.doc_id, least.get(g, r.doc_id))
    want = [(r.doc_id, f"{p:016x}", least[g]) for r, p, g in zip(docs, prints, groups)]
    assert found(spark, "op9_simhash") == sorted(want)


def test_line_dedup_sql_on_null_texts(spark, tmp_path):
    """Every document is a row, also one without a text."""
    rows = [(i, None if i % 5 == 0 else f"on every site\nown {i}", "en", f"s{i % 12}", i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = check_queries.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert check_queries.compare(spark, con, str(tmp_path), "op10_line_dedup") is None
    found = {r.doc_id: r for r in QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()}
    assert sorted(found) == list(range(40))
    assert found[0].n_lines == found[0].n_removed == 0 and found[0].kept_sha256 == hashlib.sha256().hexdigest()
