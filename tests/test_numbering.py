"""Numbering and total order over many partitions."""

import random

import pytest
from pyspark.sql import functions as F

from wardlens.operators import numbering as N


def rows(seed, size=400):
    rng = random.Random(seed)
    # a third of the rows are copies of one row
    return [(5, "copy") if rng.random() < 0.34 else (rng.choice((None, *range(20))), rng.choice(("a", "b", None))) for _ in range(size)]


@pytest.mark.parametrize("seed", [1, 2])
def test_row_numbers_are_gapless_and_in_order(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data, "k int, _start string").repartition(5)
    got = sorted(N.number_rows(df.withColumnRenamed("_start", "v"), ["k", F.desc("v")], "n", pieces=7).collect(), key=lambda r: r.n)
    assert [r.n for r in got] == list(range(1, len(data) + 1))
    want = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, [-ord(c) for c in r[1] or ""] or [9]))
    assert [(r.k, r.v) for r in got] == want


def test_a_constant_order_numbers_every_row(spark):
    got = N.number_rows(spark.range(50).repartition(4), [], "n").collect()
    assert sorted(r.n for r in got) == list(range(1, 51))
    assert N.number_rows(spark.range(0), ["id"]).count() == 0


def test_copies_spread_over_pieces_and_files_are_in_order(spark, scratch):
    df = spark.createDataFrame(rows(3, 6000), "k int, v string").repartition(6)
    ordered = N.total_order(df, ["k", "v"], pieces=6)
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * 6000 / 6  # copies hold a third of the rows
    ordered.write.parquet(f"{scratch}/t")
    import glob

    import pyarrow.parquet as pq
    seen = [(r["k"], r["v"]) for f in sorted(glob.glob(f"{scratch}/t/part-*.parquet")) for r in pq.ParquetFile(f).read().to_pylist()]
    assert seen == sorted(((r.k, r.v) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def test_first_appearance(spark):
    rng = random.Random(7)
    data = [(i, rng.choice(("hot", None, *"abcdefghij"))) for i in range(300)]
    seen = list(dict.fromkeys(k for _, k in data if k is not None))
    shuffled = spark.createDataFrame(rng.sample(data, len(data)), "pos int, key string").repartition(5)
    assert {r.key: r.group_number for r in N.first_appearance(shuffled, "key", "pos", pieces=4).collect()} == {k: i for i, k in enumerate(seen)}
    got = N.with_group_number(shuffled, "key", ["pos"]).collect()
    assert {(r.pos, r.key, r.group_number) for r in got} == {(i, k, None if k is None else seen.index(k)) for i, k in data}


def test_first_appearance_of_ties_and_numbers(spark):
    df = spark.createDataFrame([(1, 30), (1, 20), (0, 10), (2, 20), (None, 40)], "pos int, key int")
    assert {r.key: r.group_number for r in N.first_appearance(df, "key", "pos").collect()} == {40: 0, 10: 1, 20: 2, 30: 3}
    assert N.with_group_number(df, "key", "pos").count() == 5
