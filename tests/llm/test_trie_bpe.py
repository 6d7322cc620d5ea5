import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import doc
from wardlens.llm import trie_bpe
from wardlens.llm.registry import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def own():
    return trie_bpe.TrieBpe(tokenizer_path())


def same(library, own, texts):
    ids = own.encode_batch(texts)
    ends = np.cumsum([0, *(len(b) // 4 for b in ids)], dtype=np.int64)
    decoded = own.decode_batch(np.frombuffer(b"".join(ids), "<i4"), ends)
    for t, i, d in zip(texts, ids, decoded, strict=True):
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(i, "<i4").tolist() == want, t[:80]
        assert d == library.decode(want, skip_special_tokens=False)


HARD = ["", " ", "\n\t", "<|endoftext|>hello<|startoftext|> World's  don't\tÅngström éx 123 ５ ﬁ ǅ", "İSTANBUL Σίσυφος ΣΑΣ ẞ K ſ",
        "a" * 5000, "!!!???...'''s 'll've\x1c\x85x y z", "日本語テキスト 🎉👩‍👩‍👧", "́abc ́", "é é ǆ", "aaa abababab " * 50,
        "<|endoftext|><|endoftext|>", "x<|endoftext|", "the of and 'S 'LL '", "\r\n\x0b\x0c", "\x00\x01\x7f", "µªº ßſ ÀÖØ"]


def test_hard_texts_equal_the_library(library, own):
    same(library, own, HARD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=10))
def test_random_texts_equal_the_library(library, own, texts):
    same(library, own, [t.encode("utf-8", "ignore").decode() for t in texts])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ainoetshrld'.,AEé ", max_size=200), max_size=10))
def test_wordlike_texts_equal_the_library(library, own, texts):
    same(library, own, texts)


def test_a_thinned_cache_changes_nothing(library, own, monkeypatch):
    monkeypatch.setattr(trie_bpe, "CACHE_ENTRIES", 5)
    for _ in range(3):
        same(library, own, HARD)


def test_rows(make, library):
    docs = make([doc(i, t) for i, t in enumerate(HARD)] + [doc(99, None), doc(None, "x"), doc(1, " ")])
    rows = trie_bpe.bpe_rows(docs.withColumn("ids", F.lit(1)), tokenizer_path()).collect()
    assert len(rows) == len(HARD) + 3
    for r in rows:
        text = "x" if r.doc_id is None else HARD[r.doc_id] if r.doc_id < 99 else ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert trie_bpe.bpe_rows(make([]), tokenizer_path()).count() == 0
