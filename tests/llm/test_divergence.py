import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import doc
from wardlens.llm import divergence

UNIT = 1_000_000_000
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=3, top=200):
    """The definition, term by term."""
    n, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = TERM.findall(low)
        n[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = sorted(t for t, c in df[lang].items() if c >= min_docs)
        sources = [s for g, s in groups if g == lang]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + UNIT * (counts[t] + 1) // (total + len(kept)) for t in kept}
        mine = shares(n[lang, source])
        pairs = []
        for other in sources:
            if other != source:
                q = shares(n[lang, other])
                pairs.append((other, sum((mine[t] - q[t]) ** 2 // q[t] for t in kept)))
        q = shares(sum((n[lang, s] for s in sources), Counter()))
        terms = [(t, (mine[t] - q[t]) ** 2 // q[t]) for t in kept if n[lang, source][t] and mine[t] > q[t]]
        for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, i, v, k + 1) for k, (i, v) in enumerate(items[:limit])]
    return sorted(out)


def rows_of(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, size=120, words=40):
    rng = random.Random(seed)
    vocabulary = [f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(words)] + ["Éa", "éa", "日本", "ÀB", "x'y", "A", "a"]
    rows = []
    for i in range(size):
        text = " ".join(rng.choice(vocabulary[: rng.choice((5, 20, 47))]) for _ in range(rng.choice((0, 1, 5, 40))))
        rows.append(doc(i if i % 9 else None, text, rng.choice(("en", "en", "fr", None, "")), rng.choice(("s0",) * 5 + ("s1", "s2", "é", "z", None))))
    return rows + rows[:7] + [doc(900, None, "xx", "only"), doc(901, "", "xx", "other"), doc(902, "rare words", "yy", "a"),
                              doc(903, None, None, None), doc(904, "big " * 20_000, "en", "s1")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_definition(make, seed, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 25 if seed == 2 else 300_000)
    rows = corpus(seed)
    docs = make(rows).withColumn("rank", F.lit("x")).withColumn("term", F.lit(3)).withColumn("n", F.lit(None))
    assert rows_of(divergence.audit(docs)) == brute(rows)


def test_parameters_and_cut(make):
    rows = corpus(3)
    assert rows_of(divergence.audit(make(rows), min_docs=1, top=4)) == brute(rows, 1, 4)


def test_shared_paths_are_counted_once_each(make):
    """Combinations of a node and an ancestor, against all pairs of counts of every term."""
    groups, kept = divergence.term_rows(divergence.term_counts(make(corpus(4))))
    want = Counter()
    for r in kept.collect():
        for i, x in enumerate(r.path):
            for y in r.path[i + 1:]:
                want[r.lang, x["rank"], x.n, y["rank"], y.n] += 1
    got = divergence.shared_pairs(kept).collect()
    assert len(got) == len(want)
    assert {tuple(r)[:5]: r.times for r in got} == want


def test_large_counts_stay_exact(spark):
    """Counts beyond what a 64-bit product of them would hold."""
    groups = spark.createDataFrame([("l", "a", 0, 9 * 10**15, 18 * 10**15, 2), ("l", "b", 1, 9 * 10**15, 18 * 10**15, 2)],
                                   "lang string, source string, rank int, total bigint, lang_total bigint, terms bigint")
    n = 9 * 10**15 - 7
    kept = spark.createDataFrame([("l", "x", n + 7, [(0, n), (1, 7)]), ("l", "y", n + 7, [(0, 7), (1, n)])],
                                 "lang string, term string, n bigint, path array<struct<rank:int,n:bigint>>")
    share = [1 + UNIT * (c + 1) // (9 * 10**15 + 2) for c in (n, 7)]
    want = sum((p - q) ** 2 // q for p, q in (share, share[::-1]))
    assert {(r.a, r.b): r.value for r in divergence.pair_divergence(groups, kept).collect()} == {(0, 1): want, (1, 0): want}


def test_empty_table(make):
    assert divergence.audit(make([])).count() == 0
    assert rows_of(divergence.audit(make([doc(1, None, None, None), doc(2, "", "", "b")]))) == [
        ("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]
