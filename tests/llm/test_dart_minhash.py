import collections
import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import doc
from wardlens.llm import dart_minhash as d


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Class id of each text by all pairs."""
    texts = sorted({t or "" for _, t in rows})
    sets, up = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / (len(sets[i]) + len(sets[j]) - both) >= 0.8:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    of = {t: find(i) for i, t in enumerate(texts)}
    least = {}
    for i, t in rows:
        least[of[t or ""]] = min(i, least.get(of[t or ""], i))
    return {(i, t): least[of[t or ""]] for i, t in rows}


def edited(words, n, rng):
    w = list(words)
    for k in rng.sample(range(len(w)), n):
        w[k] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def family(rng, size, n_words, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(n_words)]
    return [" ".join(base)] + [edited(base, rng.randint(*edits), rng) for _ in range(size)]


def test_classes_equal_brute_force(spark):
    rng = random.Random(5)
    texts = family(rng, 120, 150, (1, 9)) + family(rng, 6, 60, (0, 2)) + family(rng, 3, 1200, (5, 60))
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randint(1, 80))) for _ in range(60)]
    texts += ["", None, "   ", "one", "ONE", "one two", texts[0], texts[0], texts[0].upper(), "a b c d e f g"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    want = brute(rows)
    got = d.class_rows(df).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: c for (i, _), c in want.items()}
    assert len(got) == len(rows)
    kept = collections.Counter(r.class_id for r in got if r.kept)
    assert set(kept) == set(want.values()) and max(kept.values()) == 1


def test_large_group_of_near_copies_without_links(spark):
    """A bucket full of texts that are alike, but below the threshold, and a chain through them."""
    rng = random.Random(7)
    base = [f"w{k}" for k in range(120)]
    texts = [edited(base, 9, rng) for _ in range(60)]
    texts += [edited(texts[0].split(), 1, rng), edited(texts[1].split(), 1, rng)]
    rows = list(enumerate(texts))
    got = d.class_rows(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: c for (i, _), c in brute(rows).items()}


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    n, k = 400, 1024
    h = rng.integers(0, 2**63, n).astype(np.uint64)
    wa, wb = rng.integers(1, 6, n).astype(float), rng.integers(1, 6, n).astype(float)
    sa, _ = d.signatures(h, np.zeros(n, int), 1, wa, k)
    sb, _ = d.signatures(h, np.zeros(n, int), 1, wb, k)
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((sa == sb).mean() - want) < 0.06
    half, _ = d.signatures(h[:200], np.zeros(200, int), 1, None, k)
    full, _ = d.signatures(h, np.zeros(n, int), 1, None, k)
    assert abs((half == full).mean() - 0.5) < 0.06


def test_signature_does_not_depend_on_the_batch():
    rng = np.random.default_rng(4)
    parts = [rng.integers(0, 2**63, m).astype(np.uint64) for m in (1, 40, 3000)]
    together, some = d.signatures(np.concatenate(parts), np.repeat([0, 2, 3], [1, 40, 3000]), 4)
    assert some.tolist() == [True, False, True, True]
    for row, p in zip((0, 2, 3), parts, strict=True):
        alone, _ = d.signatures(p, np.zeros(len(p), int), 1)
        assert (alone[0] == together[row]).all()


def test_weighting_by_count_keeps_the_classes(spark):
    rng = random.Random(9)
    texts = family(rng, 10, 100, (1, 3)) + ["same words again " * 30, "same words again " * 31]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = d.near_duplicates(df, weighting="count").collect()
    assert {r.doc_id: r.class_id for r in got} == {i: c for (i, _), c in brute(rows).items()}


def test_nulls_repeats_clashes_and_the_empty_table(make):
    text = "a text of some seven or eight words"
    docs = make([doc(3, text), doc(3, text), doc(2, text + " "), doc(None, text), doc(4, None), doc(5, ""), doc(6, " ")])
    rows = [(r.doc_id, r.class_id, r.kept) for r in d.class_rows(docs.withColumn("node", F.lit(1))).collect()]
    classes = {i: c for i, c, _ in rows}
    nameless = min(classes)  # the row without an id: a negative stand-in
    assert len(rows) == 7 and nameless < 0 and classes[3] == classes[2] == classes[nameless] == nameless
    assert classes[4] == classes[5] == 4 and classes[6] == 6
    assert d.class_rows(make([])).count() == 0
    kept = d.keep_one(docs.withColumn("fp", F.lit("x"))).collect()
    assert len(kept) == 3 and kept[0].fp == "x"
    twice = d.keep_one(make([doc(3, text), doc(3, text), doc(7, text)])).collect()
    assert [(r.doc_id, r.text, r.source) for r in twice] == [(3, text, "s")]
