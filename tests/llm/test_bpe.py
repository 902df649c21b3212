"""Ids and decoded texts equal the library's."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lotwise.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "",
    None,
    " \n ",
    "Hello, World! It's 2024 and we'll see",
    "aaaaaaa aaaa aaa aa a bananananana",
    "x<|endoftext|>Y <|startoftext|><|endoftext|> <|endoftext| >",
    "naïve CAFÉ ÀÉÎ Straße İstanbul ΟΔΟΣ ǅ ﬁ é Å ́x",
    "日本語 テスト 😀😀  nb sp x\x85y\x1c!\x1cz",
    "don't can'T I'LL 'sss ''s x's's",
    "µ ª º × ÷ ÿ Ÿ ẞ",
    "supercalifragilisticexpialidocious " * 30,
    "z" * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def want(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    shown = library.decode(ids, skip_special_tokens=False)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return doc_id, len(ids), digest(np.array(ids, "<u4").tobytes()), digest(shown.encode())


def test_equals_library(spark, library, monkeypatch):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 1), (None, TEXTS[5], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe.encode_digests(docs, PATH).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((want(library, i, t) for i, t, _ in rows), key=repr)


def test_round_trip(spark, library):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    encoded = bpe.encode(docs, PATH)
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    texts = {r.doc_id: r.text for r in bpe.decode(encoded, PATH).collect()}
    for i, t in enumerate(TEXTS):
        assert ids[i] == library.encode(t or "", add_special_tokens=False).ids
        assert texts[i] == library.decode(ids[i], skip_special_tokens=False)


def test_empty_table(spark):
    assert bpe.encode_digests(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


@given(st.text(alphabet="ab'st dÉß1!\ń<|endoftext>", max_size=60))
@settings(max_examples=150, deadline=None)
def test_any_text(text):
    if not hasattr(test_any_text, "made"):
        test_any_text.made = bpe.WordBpe(PATH), Tokenizer.from_file(PATH)
    own, library = test_any_text.made
    words = text.encode().split()
    own.learn(set(words))
    assert np.frombuffer(own.encode(words), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_small_parts(library, monkeypatch):
    """Parts and blocks of a few bytes, and a memo that is emptied at once, change nothing."""
    import pyarrow as pa

    monkeypatch.setattr(bpe, "BLOCK_BYTES", 8)
    monkeypatch.setattr(bpe, "MEMO", 3)
    monkeypatch.setattr(bpe.text_parts, "__defaults__", (8,))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS)], ["doc_id", "text"])
    (out,) = bpe._digests(PATH)(iter([batch]))
    assert [tuple(r.values()) for r in out.to_pylist()] == [want(library, i, t) for i, t in enumerate(TEXTS)]


def test_other_splits_are_refused():
    with pytest.raises(ValueError):
        bpe.WordBpe(public_tokenizers.path("byte_bpe_50k.json"))
