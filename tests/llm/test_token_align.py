import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import doc
from wardlens.llm import token_align
from wardlens.llm.registry import aligned_paths

pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def sides():
    a, b = aligned_paths()
    return token_align.ByteSide(a), token_align.PieceSide(b)


def plain(sides, text):
    """Groups of one text, from the libraries on the whole text and the set of all ends."""
    a, b = sides
    if not text:
        return []
    ids_a = a.library.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.library.encode(text, num_threads=1)
    raw = [[a.raw[i] for i in ids_a], [b.raw[i] for i in ids_b]]
    if any(b"".join(r) != (" " + text).encode() for r in raw):
        return []
    ends = [np.cumsum([len(t) for t in r]).tolist() for r in raw]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    out, lo = [], 0
    for c in cuts:
        out.append(([i for i, e in zip(ids_a, ends[0], strict=True) if lo < e <= c],
                    [i for i, e in zip(ids_b, ends[1], strict=True) if lo < e <= c]))
        lo = c
    return out


def brute(sides, texts):
    groups = [plain(sides, t) for t in texts]
    links = [Counter((x, y) for xs, ys in g for x in xs for y in ys) for g in groups]
    count = Counter(p for ps in links for p in ps)
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    rows = []
    for g, ps in zip(groups, links, strict=True):
        shown = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in g)
        rows.append((sum(len(xs) for xs, _ in g), sum(len(ys) for _, ys in g), len(g), sum(ps.values()),
                     sum(n for p, n in ps.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in ps.items()),
                     hashlib.sha256(shown.encode()).hexdigest() if g else ""))
    return rows, {p: (n, n == top[p[0]]) for p, n in count.items()}


HARD = ["", None, " ", "  ", "a", "a  b", "a   b \n c\n\nd\t e", " lead", "trail ", "trail  \n ", "a▁b", "x ▁ y", "ok▁", "<|endoftext|> <s></s> <unk> <0x41>",
        "日本語テキスト 🎉👩‍👩‍👧 naïve İstanbul ﬁ", "a 　 b\x1cc d\x00", "zzzzzzzzzzzzzzzzzzzzzzzz" * 20, "12345 678901 3.14159",
        "Ūñîçødé ẞtraße", "the the the of and", "the the the of and", "\n", "\n\n x", "é" * 50 + "\n" + "ab" * 99]


def test_rows_equal_brute_force(make, sides):
    texts = HARD + ["The quick brown fox, jumps over the lazy dog. " * 3, "qwrtzpsdfghjklxcvbnm" * 40]
    docs = make([doc(i, t) for i, t in enumerate(texts)], partitions=4)
    got = token_align.align_rows(docs.withColumn("block", F.lit(1)).withColumn("id", F.lit("x")), *aligned_paths()).collect()
    want, counts = brute(sides, texts)
    rows = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got}
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert rows[i] == w, texts[i]
    pairs = token_align.pair_counts(docs, *aligned_paths()).collect()
    assert {(r.a_id, r.b_id): (r.n_docs, r.best) for r in pairs} == counts
    plainly = {r.doc_id: r.groups for r in token_align.align(docs, *aligned_paths()).collect()}
    assert {i: hashlib.sha256(g.encode()).hexdigest() if g else "" for i, g in plainly.items()} == {i: w[-1] for i, w in enumerate(want)}


def test_blocks_of_any_size_give_the_same(make, sides, monkeypatch):
    rng = np.random.default_rng(5)
    words = ["alpha", "beta,", "gam\nma", "δέλτα", "x▁y", "  ", "12.5", "Zürich."]
    texts = [" ".join(rng.choice(words[:4] + words[5:] if i % 5 else words, rng.integers(0, 12))) for i in range(60)]
    docs = make([doc(i // 2 if i % 7 else None, t) for i, t in enumerate(texts)], partitions=3)
    monkeypatch.setattr(token_align, "BLOCK_BYTES", 60)
    from wardlens.llm import common
    monkeypatch.setattr(common, "PART_BYTES", 40)
    got = sorted(tuple(r)[1:] for r in token_align.align_rows(docs, *aligned_paths()).collect())
    # the digest comes last on both sides
    assert got == sorted(brute(sides, texts)[0])


def test_empty_table(make):
    assert token_align.align_rows(make([]), *aligned_paths()).count() == 0
    assert token_align.align_rows(make([doc(1, None), doc(2, "")]), *aligned_paths()).count() == 2


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=30), min_size=1, max_size=6), st.randoms(use_true_random=False))
def test_cuts_are_all_common_ends(lengths, random):
    """Several intervals at once, against the plain intersection."""
    ends_a, ends_b, lo, hi, at = [], [], [], [], 0
    for sizes in lengths:
        lo.append(len(ends_a))
        ends_a += (at + np.cumsum(sizes)).tolist()
        hi.append(len(ends_a))
        total = sum(sizes)
        ends_b += sorted(at + e for e in {total, *(random.randint(1, total) for _ in range(random.randint(0, 20)))})
        at += total
    got = token_align.shared_cuts(np.array(ends_a), np.array(ends_b), np.array(lo), np.array(hi)).tolist()
    outer = {h - 1 for h in hi}
    assert got == [i for i, e in enumerate(ends_a) if e in set(ends_b) and i not in outer]


def test_a_long_interval_without_cuts_is_one_group():
    n = 200_000
    a, b = np.arange(1, n + 1) * 2, np.append(np.arange(n - 1) * 2 + 1, 2 * n)
    assert token_align.shared_cuts(a, b, np.array([0]), np.array([n])).tolist() == []
    assert token_align.shared_cuts(a, a, np.array([0]), np.array([n])).tolist() == list(range(n - 1))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab'sré1. ,\n\t  日▁😀", max_size=60))
def test_chunks_are_safe(sides, text):
    got = token_align.Block(*sides, [text])
    want = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in plain(sides, text))
    assert got.groups(0).decode() == want


class Counted:
    """A side that counts the strings its library gets."""

    def __init__(self, side):
        self.raw, self.chunks_apart, self.side, self.strings = side.raw, side.chunks_apart, side, 0

    def encode(self, chunks):
        self.strings += len(chunks)
        return self.side.encode(chunks)


def apart(side, chunks):
    ids = [side.encode([c])[0] for c in chunks]
    return ([len(x) for x in ids], [b"".join(side.raw[i] for i in x) == c.encode() for x, c in zip(ids, chunks, strict=True)],
            [i for x in ids for i in x])


def chunks_of(texts):
    return list(dict.fromkeys(c for t in texts if t for c in token_align._CHUNK.findall(" " + t)))


@pytest.mark.parametrize("step", [token_align.STEP, 7])
def test_chunks_go_to_the_libraries_in_long_strings(sides, monkeypatch, step):
    monkeypatch.setattr(token_align, "STEP", step)
    words = [f" {'xyzü'[i % 4]}{i}" for i in range(1000)]
    for side in sides:
        for chunks, most in ((words, 1000 / min(step, token_align.JOIN) + 1), (chunks_of(HARD), 1000), ([], 0)):
            counted = Counted(side)
            assert tuple(x.tolist() for x in token_align._encoded(counted, chunks)) == apart(side, chunks)
            assert counted.strings <= most


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab'sré1. ,\n\t\x1c\x85\u3000▁<>日😀", max_size=12), max_size=40))
def test_joined_chunks_are_encoded_as_alone(sides, texts):
    chunks = chunks_of(texts)
    for side in sides:
        assert tuple(x.tolist() for x in token_align._encoded(side, chunks)) == apart(side, chunks)


def test_tokens_over_the_ends_of_chunks_are_not_used():
    class Greedy:
        """Two chunks in one string become one token."""
        raw, chunks_apart = [b" a", b" b", b" a b", b" c"], True

        def encode(self, chunks):
            return [{" a": [0], " b": [1], " a b": [2], " c": [3], " a b c": [2, 3]}[c] for c in chunks]

    got = token_align._encoded(Greedy(), [" a", " b", " c"])
    assert [x.tolist() for x in got] == [[1, 1, 1], [True] * 3, [0, 1, 3]]
