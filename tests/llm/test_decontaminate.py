import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import doc
from wardlens.llm import decontaminate as d

BENCH = "item_id bigint, text string"


def plain_alignment(a, b):
    """Smith-Waterman score, cell by cell."""
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1),
                             rows[i - 1][j] - 1, rows[i][j - 1] - 1)
            best = max(best, rows[i][j])
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=14), st.lists(st.integers(0, 5), max_size=20))
def test_alignment_score(a, b):
    score, start, end = d.align(a, b)
    assert score == plain_alignment(a, b)
    if score:
        assert plain_alignment(a, b[start:end]) == score


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 5), min_size=1, max_size=14), st.lists(st.integers(0, 5), max_size=20)),
                max_size=8))
def test_scores_of_many(pairs):
    assert d.best_scores(pairs) == [plain_alignment(a, b) for a, b in pairs]


def words(rng, n):
    return [f"v{rng.randrange(3000)}" for _ in range(n)]


def test_copies_edits_and_clean_texts(make):
    rng = random.Random(2)
    items = [words(rng, n) for n in (40, 25, 15, 3, 1)]
    bench = make([*((k, " ".join(w)) for k, w in enumerate(items)), (7, None), (8, ""), (None, "q r s t u")], BENCH)

    def around(w):
        return " ".join(words(rng, 200) + w + words(rng, 200))
    swapped = [w if k % 6 else "changed" for k, w in enumerate(items[0])]
    dropped = [w for k, w in enumerate(items[0]) if k % 9]
    rows = [doc(0, around(items[0])), doc(1, around(items[0]).upper().replace(" ", ", ")), doc(2, around(swapped)),
            doc(3, around(dropped)), doc(4, around(items[1]) + " " + around(items[2])), doc(5, around([])),
            doc(6, None), doc(7, ""), doc(8, around(items[0][:8])), doc(9, around(items[3])), doc(0, around(items[0]))]
    got = {(r.doc_id, r.item_id): r for r in d.leak_rows(make(rows).withColumn("item", F.lit(1)), bench).collect()}
    assert {(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (4, 2), (9, 3)} <= set(got)
    assert not {k for k in got if k[0] in (5, 6, 7, 8) and k[1] != 4}
    assert got[0, 0].score == got[1, 0].score == 1 and (got[0, 0].first_word, got[0, 0].end_word) == (200, 240)
    assert 0.7 < got[2, 0].score < 1 and 0.8 < got[3, 0].score < 1
    kept = d.clean(make(rows), make([(0, " ".join(items[0]))], BENCH))
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 7, 8, 9] and kept.columns == make(rows).columns


def test_an_item_that_most_documents_copy_is_found(make):
    rng = random.Random(3)
    item = words(rng, 30)
    rows = [doc(k, " ".join(words(rng, 30) + item)) for k in range(60)] + [doc(99, " ".join(words(rng, 60)))]
    got = d.leak_rows(make(rows), make([(1, " ".join(item))], BENCH)).collect()
    assert sorted(r.doc_id for r in got) == list(range(60))


def test_blocks_of_the_benchmark_and_empty_tables(make):
    rng = random.Random(4)
    items = [words(rng, 20) for _ in range(7)]
    bench = make([(k, " ".join(w)) for k, w in enumerate(items)], BENCH)
    docs = make([doc(k, " ".join(words(rng, 50) + w)) for k, w in enumerate(items)])
    got = d.contamination(docs, bench, max_items=3).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(k, k) for k in range(7)]
    assert d.leak_rows(docs, make([], BENCH)).count() == 0
    assert d.leak_rows(make([]), bench).count() == 0
    assert d.clean(docs, make([], BENCH)).count() == 7


def test_seeds_by_number():
    index = d.SeedIndex([(1, "a b c d e"), (2, "b c d e f"), (3, "x y")])
    number = np.array([index.number.get(w, 0) for w in "z a b c d e x y".split()], np.int64)
    hits = {(place, tuple(index.at[s])) for place, s in index.hits(number)}
    assert hits == {(1, ((0, 0),)), (2, ((0, 1), (1, 0))), (6, ((2, 0),))}


def test_one_exact_copy_changes_no_other_verdict(make):
    rng = random.Random(5)
    item = [f"w{k}" for k in range(40)]
    edited = [f"x{k}" if k >= 20 and k % 3 == 0 else w for k, w in enumerate(item)]
    rows = [doc(k, " ".join(words(rng, 30) + edited)) for k in range(40)]
    bench = make([(1, " ".join(item))], BENCH)
    without = {(r.doc_id, r.score) for r in d.leak_rows(make(rows), bench).collect()}
    with_copy = {(r.doc_id, r.score) for r in d.leak_rows(make([*rows, doc(99, " ".join(item))]), bench).collect()}
    assert len(without) == 40 and with_copy == without | {(99, 1.0)}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=14), st.lists(st.integers(0, 6), max_size=40))
def test_stretches_lose_nothing_against_brute_force(item, text):
    """Every text whose best alignment reaches the points is proposed, and so is that alignment."""
    index = d.PairIndex([(1, " ".join(f"w{w}" for w in item))], 0.5)
    numbers = np.array([index.number.get(f"w{w}", 0) for w in text], np.int64)
    spans = index.stretches(numbers).get(0, [])
    found = max((d.align(index.words[0], numbers[a:b])[0] for a, b in spans), default=0)
    best = plain_alignment(index.words[0], numbers.tolist())
    assert index.points[0] == max(len(item), min(7, 2 * len(item)))
    assert found == best if best >= index.points[0] else found <= best


def test_edits_every_few_words_are_found(make, monkeypatch):
    rng = random.Random(6)
    rows, want = [], {}
    item = [f"i{k}" for k in range(40)]
    edits = [[w if k % n else "changed" for k, w in enumerate(item, 1)] for n in (4, 5)]
    edits += [[w for k, w in enumerate(item, 1) if k % n] for n in (3, 4, 5)]
    edits += [[x for k, w in enumerate(item, 1) for x in ([w] if k % n else [w, "more"])] for n in (2, 3, 4, 5)]
    edits.append([w if k % 3 else "changed" for k, w in enumerate(item[:-1] + ["z"], 1)])
    for k, w in enumerate(edits):
        text = words(rng, 60) + w + words(rng, 60)
        rows.append(doc(k, " ".join(text)))
        want[k] = plain_alignment(item, text) / 80
    for common in (64, 0):  # with all places, and with the common ones left out
        monkeypatch.setattr(d, "COMMON", common)
        got = {r.doc_id: r.score for r in d.leak_rows(make(rows), make([(1, " ".join(item))], BENCH)).collect()}
        assert got == {k: s for k, s in want.items() if s >= 0.5}
        assert len(got) >= 9


def test_a_benchmark_of_many_words_and_blocks_by_words(make):
    items = [" ".join(f"b{k}" for k in range(at, at + 30)) for at in range(0, 60_000, 30)]
    bench = make(list(enumerate(items)), BENCH)
    docs = make([doc(k, "before " + items[k] + " after") for k in (0, 7, 1999)])
    for bound in (2_000_000, 25_000):
        got = d.contamination(docs, bench, max_words=bound).collect()
        assert sorted((r.doc_id, r.item_id, r.score) for r in got) == [(k, k, 1.0) for k in (0, 7, 1999)]
