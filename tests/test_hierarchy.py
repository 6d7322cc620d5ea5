"""Referral chains (FIXTURES.md section 6)."""

import os

import pytest

from wardlens.operators import hierarchy as H
from wardlens.schema import REFERRALS

ROWS = [(1, "Alice Brown", None, "A&E", None), (2, "Alice Brown", "A&E", "Cardiology", 1),
        (3, "Alice Brown", "Cardiology", "ICU", 2), (4, "Alice Brown", "ICU", "General Ward", 3),
        (5, "Bob Clarke", None, "A&E", None), (6, "Bob Clarke", "A&E", "Orthopaedics", 5),
        (7, "Bob Clarke", "Orthopaedics", "General Ward", 6)]


def refs(spark, rows=ROWS):
    return spark.createDataFrame(rows, REFERRALS)


def test_chain_golden(spark):
    out = H.walk_hierarchy(refs(spark), max_recursion=50).orderBy("patient_name", "depth").collect()
    got = [(r.patient_name, r.depth, r.from_department, r.to_department, r.referral_path) for r in out]
    assert got == [
        ("Alice Brown", 1, None, "A&E", "Alice Brown > A&E"),
        ("Alice Brown", 2, "A&E", "Cardiology", "Alice Brown > A&E > Cardiology"),
        ("Alice Brown", 3, "Cardiology", "ICU", "Alice Brown > A&E > Cardiology > ICU"),
        ("Alice Brown", 4, "ICU", "General Ward", "Alice Brown > A&E > Cardiology > ICU > General Ward"),
        ("Bob Clarke", 1, None, "A&E", "Bob Clarke > A&E"),
        ("Bob Clarke", 2, "A&E", "Orthopaedics", "Bob Clarke > A&E > Orthopaedics"),
        ("Bob Clarke", 3, "Orthopaedics", "General Ward", "Bob Clarke > A&E > Orthopaedics > General Ward"),
    ]


def test_roots_and_parent_links(spark):
    assert H.roots(refs(spark)).count() == 2
    links = H.parent_links(refs(spark)).collect()
    assert len(links) == 5 and all(r.parent_id == r.parent_referral_id for r in links)


def test_recursion_limit_counts_rounds(spark):
    # a 4-deep chain needs 3 recursive rounds: limit 3 passes, limit 2 fails
    assert H.walk_hierarchy(refs(spark), max_recursion=3).count() == 7
    with pytest.raises(H.RecursionLimitExceeded) as e:
        H.walk_hierarchy(refs(spark), max_recursion=2)
    assert (e.value.error_number, e.value.max_recursion, e.value.unfinished) == (530, 2, 1)


def test_edges_are_one_file_per_bucket_and_dropped(spark, monkeypatch):
    rows = spark.range(3000).selectExpr(
        "cast(id as int) referral_id", "'p' patient_name", "'a' from_department", "'b' to_department",
        "cast(id - 1 as int) parent_referral_id").repartition(16)
    df, name = H._bucketed_edges(rows, ["parent_referral_id"])
    assert len(df.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    spark.sql(f"DROP TABLE {name}")
    assert not os.path.exists(folder)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "16")  # more partitions than buckets allowed
        assert H.walk_hierarchy(refs(spark), max_recursion=3).count() == 7
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")


def test_depth_guard_truncates_silently(spark):
    out = H.walk_hierarchy(refs(spark), max_recursion=10, depth_guard=2).collect()
    assert max(r.depth for r in out) == 2 and len(out) == 4


def test_wrong_join_fails_fast(spark):
    # the runaway of the reference: start from every row and join parent to parent
    from pyspark.sql import functions as F
    with pytest.raises(H.RecursionLimitExceeded):
        H.walk_hierarchy(refs(spark), id_cols=("parent_referral_id",), parent_cols=("parent_referral_id",),
                         start=F.lit(True), max_recursion=10, depth_guard=100)


def test_cycle_reachable_from_root_fails(spark):
    # with single parent pointers a cycle is reachable from a root only through a repeated id:
    # 8 (root) -> 9 -> 10 -> 9 (second row with id 9, parent 10) -> 10 -> ...
    rows = ROWS + [(8, "Cy", None, "A&E", None), (9, "Cy", "A&E", "X", 8), (10, "Cy", "X", "Y", 9),
                   (9, "Cy", "Y", "X", 10)]
    with pytest.raises(H.RecursionLimitExceeded):
        H.walk_hierarchy(refs(spark, rows), max_recursion=20)


def test_loop_equals_spark_recursive_cte(spark):
    refs(spark).createOrReplaceTempView("patient_referrals_t")
    sql = """
    WITH RECURSIVE chain (referral_id, patient_name, from_department, to_department, depth, referral_path) AS (
      SELECT referral_id, patient_name, from_department, to_department, 1, patient_name || ' > ' || to_department
      FROM patient_referrals_t WHERE parent_referral_id IS NULL
      UNION ALL
      SELECT p.referral_id, p.patient_name, p.from_department, p.to_department, c.depth + 1,
             c.referral_path || ' > ' || p.to_department
      FROM patient_referrals_t p JOIN chain c ON p.parent_referral_id = c.referral_id)
    SELECT patient_name, depth, from_department, to_department, referral_path FROM chain"""
    expected = sorted(map(tuple, spark.sql(sql).collect()), key=repr)
    got = H.walk_hierarchy(refs(spark)).select("patient_name", "depth", "from_department", "to_department",
                                               "referral_path").collect()
    assert sorted(map(tuple, got), key=repr) == expected


def forest(seed, size=120):
    """Trees with a deep chain, orphans and a cycle."""
    import random
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        parent = None if i == 0 or rng.random() < 0.05 else i - 1 if rng.random() < 0.8 else rng.randrange(i)
        rows.append((i, f"p{i % 7}" if i % 11 else None, None, rng.choice(("A", "B", None)) if i % 5 == 0 else f"d{i % 4}", parent))
    return rows + [(900, "o", None, "X", 899), (901, "o", None, "X", 900), (910, "c", None, "X", 911), (911, "c", None, "X", 910),
                   (912, "c", None, "X", 912), (913, "c", None, "X", 910)]


@pytest.mark.parametrize("seed,guard", [(1, None), (2, None), (3, 4), (4, 1), (5, 200)])
def test_doubling_equals_the_walk(spark, seed, guard):
    df = refs(spark, forest(seed))
    want = H.walk_hierarchy(df, max_recursion=500, depth_guard=guard)
    got = H.walk_by_doubling(df, max_recursion=500, depth_guard=guard)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_doubling_takes_log_rounds_and_keeps_the_limits(spark, monkeypatch):
    chain = [(i, "p", None, f"d{i}", i - 1 if i else None) for i in range(100)]
    cuts = []
    real = H.cut_lineage
    monkeypatch.setattr(H, "cut_lineage", lambda d: cuts.append(1) or real(d))
    got = H.walk_by_doubling(refs(spark, chain), max_recursion=99).collect()
    assert len(got) == 100 and max(r.depth for r in got) == 100 and len(cuts) == 1 + 7  # 2^7 steps reach over 99
    two = refs(spark, chain + [(500 + i, "q", None, "e", 499 + i if i else None) for i in range(6)])
    for limit in (98, 50, 3, 0):
        with pytest.raises(H.RecursionLimitExceeded) as e:
            H.walk_by_doubling(two, max_recursion=limit)
        assert (e.value.max_recursion, e.value.unfinished) == (limit, 2 if limit < 5 else 1)
    with pytest.raises(H.RecursionLimitExceeded) as e:
        H.walk_hierarchy(two, max_recursion=3)
    assert e.value.unfinished == 2
    assert max(r.depth for r in H.walk_by_doubling(refs(spark, chain), max_recursion=9, depth_guard=10).collect()) == 10


def test_doubling_refuses_repeated_ids_and_takes_composite_ones(spark):
    with pytest.raises(ValueError):
        H.walk_by_doubling(refs(spark, ROWS + [(2, "x", None, "y", 1)]))
    rows = [(c, t, "p", "d", t - 1 if t else None) for c in (1, 2, None) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, patient_name string, to_department string, parent_turn int")
    ids, parents = ("conv_id", "turn"), ("conv_id", "parent_turn")
    want = H.walk_hierarchy(df, ids, parents).collect()
    assert sorted(map(tuple, H.walk_by_doubling(df, ids, parents).collect()), key=repr) == sorted(map(tuple, want), key=repr)
    assert H.walk_by_doubling(refs(spark, [])).count() == 0
