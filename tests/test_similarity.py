"""Similarity grouping: the prefix-filtered join against all pairs, components against plain search."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardlens.operators import similarity as S
from wardlens.operators.components import min_labels


def brute(names, threshold, tokens):
    """Groups and link numbers over all pairs of distinct names."""
    bags = {n: Counter(tokens(n)) for n in names}
    df = Counter(t for b in bags.values() for t in b)
    idf = {t: math.floor(1000 * (math.log((1 + len(names)) / (1 + c)) + 1) + 0.5) for t, c in df.items()}
    vec = {n: {t: c * idf[t] for t, c in b.items()} for n, b in bags.items()}
    near = {n: set() for n in names}
    for a in names:
        for b in names:
            dot = sum(w * vec[b].get(t, 0) for t, w in vec[a].items())
            na, nb = (sum(w * w for w in vec[x].values()) for x in (a, b))
            if a != b and na and nb and dot * dot * 10**6 >= round(threshold * 1000) ** 2 * na * nb:
                near[a].add(b)
    group = {}
    for n in sorted(names):
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in group:
                group[x] = n
                todo += near[x]
    return {n: (group[n], len(near[n])) for n in names}


def py_words(n):
    return re.findall("[a-z0-9]+", n.lower())


def py_trigrams(n):
    text = f" {' '.join(py_words(n))} "
    return [] if text == "  " else [text[i:i + 3] for i in range(max(len(text) - 2, 1))]


def names_of(seed, size):
    rng = random.Random(seed)
    rare = ["".join(rng.choice("abcdeo") for _ in range(rng.randint(3, 7))) for _ in range(60)]
    common = ["hospital", "general", "st", "ltd", "and", "sons"]
    out = set()
    for _ in range(size):
        parts = [rng.choice(rare) for _ in range(rng.randint(0, 3))] + [rng.choice(common) for _ in range(rng.randint(0, 3))]
        rng.shuffle(parts)
        name = rng.choice((" ", ", ", "-")).join(parts)
        if name and rng.random() < 0.3:
            k = rng.randrange(len(name))
            name = name[:k] + rng.choice("abx") + name[k + 1:]
        out.add(name.rstrip(","))
    return sorted(out | {"", "!!", "a", "A", "a a"})


def frame(spark, names, copies=1):
    rows = [(n,) for n in names for _ in range(copies)] + [(None,)] * 3
    return spark.createDataFrame(rows, "hospital string").repartition(3)


@pytest.mark.parametrize("seed,threshold,analyzer", [(1, 0.8, "words"), (2, 0.5, "words"), (3, 0.7, "trigrams"), (4, 1.0, "words")])
def test_groups_and_links_equal_all_pairs(spark, seed, threshold, analyzer):
    names = names_of(seed, 150)
    tokens, plain = (S.words, py_words) if analyzer == "words" else (S.ngrams(3), py_trigrams)
    got = S.similar_entities(frame(spark, names, 2), threshold=threshold, tokens=tokens).collect()
    rows = {r.entity_name: (r.similar_group, r.n_links) for r in got if r.entity_name is not None}
    assert len(got) == len(names) + 1 and rows == brute(names, threshold, plain)
    assert [(r.similar_group, r.n_links, r.name_rows) for r in got if r.entity_name is None] == [(None, 0, 3)]
    assert all(r.name_rows == 2 for r in got if r.entity_name is not None)


def test_a_hot_token_is_split_into_cells(spark):
    """One token in every name: the same links, and no cell holds more than its share of the token."""
    names = [f"clinic {a}{b}" for a in "abcdefghij" for b in "klmnopqrst"] + ["clinic", "clinic clinic"]
    want = brute(names, 0.15, py_words)
    whole = {r.entity_name: (r.similar_group, r.n_links) for r in S.similar_entities(frame(spark, names), threshold=0.15).collect()}
    cut = {r.entity_name: (r.similar_group, r.n_links) for r in S.similar_entities(frame(spark, names), threshold=0.15, split=7).collect()}
    want[None] = (None, 0)
    assert whole == cut == want
    vectors = S.name_vectors(spark.createDataFrame([(n, py_words(n)) for n in names], "entity_name string, tokens array<string>"))
    placed = S._postings(vectors, 150)
    hot = placed.filter("token = 'clinic'").count()
    cells = placed.filter("token = 'clinic'").groupBy(F.pmod(F.xxhash64("rep"), F.lit(math.ceil(hot / 7)))).count()
    assert hot > 50 and max(r["count"] for r in cells.collect()) < 7 * 3


def test_the_prefix_leaves_common_tokens_out(spark):
    """A name with rare tokens is found through those only."""
    names = [f"{chr(97 + i)}{chr(98 + i)}qz hospital" for i in range(20)]
    vectors = S.name_vectors(spark.createDataFrame([(n, py_words(n)) for n in names], "entity_name string, tokens array<string>"))
    assert S._postings(vectors, 800).filter("token = 'hospital'").count() == 0


def test_plan_pairs_by_token_only(spark):
    vectors = S.name_vectors(spark.createDataFrame([("a b", ["a", "b"])], "entity_name string, tokens array<string>"))
    plan = S.similar_links(vectors)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


def test_rows_get_their_group_and_clashing_columns_stay(spark):
    df = spark.createDataFrame([(1, "cold rod Ltd", "x"), (2, "Cold Rod, Ltd,", "y"), (3, None, "z"), (4, "hot anvil", "w")],
                               "label int, hospital string, rep string")
    got = {r.label: (r.hospital, r.hospital_similar, r.rep) for r in S.resolve_similar(df).collect()}
    assert got == {1: ("cold rod Ltd", "Cold Rod, Ltd", "x"), 2: ("Cold Rod, Ltd", "Cold Rod, Ltd", "y"), 3: (None, None, "z"),
                   4: ("hot anvil", "hot anvil", "w")}


def test_empty_table_and_wrong_threshold(spark):
    assert S.similar_entities(spark.createDataFrame([], "hospital string")).count() == 0
    with pytest.raises(ValueError):
        S.similar_entities(spark.createDataFrame([("a",)], "hospital string"), threshold=0)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 3), (7, 7), (200, 201), (201, 200)]
    got = {r.node: r.label for r in min_labels(spark.createDataFrame(links, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}
    assert min_labels(spark.createDataFrame([], "a int, b int")).count() == 0
