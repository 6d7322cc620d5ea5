import collections
import itertools
import os
import zlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import doc
from wardlens.llm import flow_reshard as f


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.tuples(st.integers(0, 4), st.integers(1, 4)), st.integers(1, 5), min_size=1, max_size=8), st.integers(1, 4))
def test_the_flow_moves_the_fewest_bytes(counts, n_new):
    sums = {(old, c): (n, n * 2 ** c) for (old, c), n in counts.items()}
    plan = f.solve(sums, n_new)
    total = sum(counts.values())
    assert sum(plan.capacity) == total and max(plan.capacity) - min(plan.capacity) <= 1
    for s in range(n_new):
        assert sum(k for (old, _), k in plan.stay.items() if old == s) <= plan.capacity[s]
    # brute force: over all ways to give the remainder, keep the largest documents of every old shard
    best = None
    for extra in itertools.combinations(range(n_new), total % n_new):
        kept = 0
        for s in range(n_new):
            sizes = sorted((2 ** c for (old, c), n in counts.items() if old == s for _ in range(n)), reverse=True)
            kept += sum(sizes[:total // n_new + (s in extra)])
        moved = sum(n * 2 ** c for (_, c), n in counts.items()) - kept
        best = moved if best is None else min(best, moved)
    assert plan.moved_bytes == best


def test_flow_takes_the_cheap_way_first():
    g = f.Flow(4)
    cheap, dear, last = g.add(0, 1, 3, 1), g.add(0, 2, 5, 4), g.add(1, 3, 2, 0)
    g.add(2, 3, 9, 0)
    assert g.run(0, 3) == (7, 2 + 20) and (g.sent(cheap), g.sent(dear), g.sent(last)) == (2, 5, 2)


def rows_of(n, hot=0.5):
    return [doc(i, "t" * (i % 97), source="hot" if i < n * hot else f"s{i % 5}") for i in range(n)]


def check(rows, docs, shards):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_rows_law_slots_and_checksums(make):
    rows = rows_of(403)
    docs = make(rows + [doc(None, None), (1000, "é" * 40_000, None, None, 1), doc(5, "same"), doc(5, "same"), doc(6, None)])
    got = f.shard_rows(docs.withColumn("shard", F.lit(-1)).withColumn("block", F.lit("x"))).collect()
    assert len(got) == 408
    check(got, docs, 40)
    texts = collections.Counter((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in
                                rows + [doc(None, None), (0, "é" * 40_000), doc(5, "same"), doc(5, "same"), doc(6, None)])
    assert collections.Counter((r.size, r.text_crc32) for r in got) == texts
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    assert all(r.shard == r.old_shard for r in got if not r.moved)


def test_fewer_rows_than_shards_and_the_empty_table(make):
    got = f.shard_rows(make([doc(i, "x") for i in range(7)])).collect()
    assert sorted(r.slot for r in got) == [0] * 7 and len({r.shard for r in got}) == 7
    assert f.shard_rows(make([])).count() == 0


def test_small_blocks_give_the_same_law(make):
    docs = make(rows_of(500)).select("doc_id", F.length("text").cast("long").alias("size"), F.lit(0).alias("old_shard"))
    got = f.reshard(docs, 3, [F.col("doc_id")], block_rows=7).collect()
    check(got, docs, 3)
    moved = [r.size for r in got if r.moved]
    stayed = [r.size for r in got if not r.moved]
    assert max(moved) <= min(stayed)  # the small ones move


def test_transfers_and_rewritten_files(make, tmp_path):
    docs = make([doc(i, "x" * i) for i in range(40)]).select(
        "doc_id", F.length("text").cast("long").alias("size"),
        F.when(F.col("doc_id") < 20, 0).when(F.col("doc_id") < 30, 1).otherwise(2).cast("int").alias("old_shard"))
    placed = f.reshard(docs, 4, [F.col("doc_id")])
    blocks = {(r.old_shard, r.shard): (r.documents, r.bytes) for r in f.transfers(placed).collect()}
    assert set(blocks) == {(0, 3)} and blocks[0, 3][0] == 10
    assert f.rewrite_affected(placed, str(tmp_path / "new")) == [0, 3]
    assert sorted(x for x in os.listdir(tmp_path / "new") if x.startswith("shard")) == ["shard=0", "shard=3"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 30)), min_size=1, max_size=60), st.integers(1, 5), st.integers(1, 9))
def test_transfers_move_exactly_the_fewest_bytes(spark, rows, n_new, block_rows):
    """Against brute force over every way to give the remainder."""
    docs = spark.createDataFrame([(i, o, s) for i, (o, s) in enumerate(rows)], "doc_id int, old_shard int, size bigint").repartition(2)
    placed = f.reshard(docs, n_new, [F.col("doc_id")], block_rows)
    got = placed.collect()
    check(got, docs, n_new)
    best = None
    for extra in itertools.combinations(range(n_new), len(rows) % n_new):
        kept = sum(sum(sorted((s for o, s in rows if o == shard), reverse=True)[:len(rows) // n_new + (shard in extra)])
                   for shard in range(n_new))
        best = max(kept, best or 0)
    moved = sum(r.bytes for r in f.transfers(placed).collect())
    assert moved == sum(s for _, s in rows) - (best or 0) == sum(r.size for r in got if r.moved)


def test_many_equal_rows_spread_over_blocks_and_know_their_transfer(make):
    docs = make([doc(7, "same text", source="hot")] * 300 + [doc(i, "x" * (i % 9), source=f"s{i}") for i in range(100)])
    got = f.shard_rows(docs).collect()
    check(got, docs, 40)
    blocks = collections.defaultdict(lambda: [0, 0])
    for r in got:
        if r.moved:
            blocks[r.old_shard, r.shard][0] += 1
            blocks[r.old_shard, r.shard][1] += r.size
    assert all([r.transfer_documents, r.transfer_bytes] == (blocks[r.old_shard, r.shard] if r.moved else [None, None]) for r in got)
    assert sum(n for n, _ in blocks.values()) > 200


def test_the_query_reads_the_rewritten_shards(make, spark):
    """Whole documents lie in the files of the shards that the plan gives them; what no transfer touches is not written again."""
    from wardlens.llm import common
    since = common.mark()
    rows = rows_of(300) + [doc(7, None, None, None), doc(7, "twice"), doc(7, "twice")]
    docs = make(rows).withColumn("shard", F.lit(-1)).withColumn("size", F.lit("x"))
    got = f.shard_rows(docs).collect()
    paths = {p.rsplit("/", 1)[1][:10]: p for p in common._STORED[since:] if "-shards-" in p}
    assert set(paths) == {"old-shards", "new-shards"}
    touched = {r.old_shard for r in got if r.moved} | {r.shard for r in got if r.moved}
    new = spark.read.parquet(paths["new-shards"]).select("shard", "slot", "document.doc_id", "document.text", "document.size")
    files = {(r.shard, r.slot): r for r in new.collect()}
    assert {s for s, _ in files} == touched
    assert {(r.shard, r.slot) for r in got if r.shard in touched} == set(files)
    for r in got:
        if r.shard in touched:
            x = files[r.shard, r.slot]
            assert (x.doc_id, x.size) == (r.doc_id, "x") and zlib.crc32((x.text or "").encode()) == r.text_crc32
    old = spark.read.parquet(paths["old-shards"]).select("document.doc_id", "document.text").collect()
    assert collections.Counter(map(tuple, old)) == collections.Counter(r[:2] for r in rows)


def test_shards_that_keep_their_documents_are_not_written(make):
    from wardlens.llm import common
    since = common.mark()
    got = f.shard_rows(make([doc(i, "x" * i, source=f"s{i}") for i in range(3)]), 1).collect()
    assert sorted(r.slot for r in got) == [0, 1, 2] and not any(r.moved for r in got)
    new = next(p for p in common._STORED[since:] if "new-shards-" in p)
    assert not any(x.startswith("shard=") for x in (os.listdir(new.removeprefix("file:")) if os.path.exists(new.removeprefix("file:")) else []))
