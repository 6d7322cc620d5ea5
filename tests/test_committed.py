"""Committed tables: a failure at any step leaves the old or the new rows, deletes rewrite only files that hold a match, and
the key index stands for the table."""

import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from wardlens import session as S
from wardlens.operators import load as L
from wardlens.operators.errorlog import ErrorLog
from wardlens.sources.committed import CommitConflict, Committed, StaleRewrite

COLUMNS = "id int, name string, kind string"


def frame(spark, rows, partitions=2):
    return spark.createDataFrame(rows, COLUMNS).repartition(partitions, "id")


def rows_of(table, **kw):
    schema = frame(table.spark, [(0, "", "")]).schema
    return sorted((tuple(r) for r in table.read(schema, **kw).collect()), key=repr)


OLD = [(i, f"n{i}", "xyz"[i % 3]) for i in range(12)]
NEW = [(i, f"m{i}", "xy"[i % 2]) for i in range(5)]


@pytest.mark.parametrize("step", ["_write", "_write_keys", "_put_lists", "_commit", "_clean", "publish"])
@pytest.mark.parametrize("run", ["first", "second"])
def test_a_failure_at_any_step_leaves_old_or_new_rows(spark, scratch, monkeypatch, step, run):
    table = Committed(spark, f"{scratch}/t")
    table.replace_run(frame(spark, OLD), "first", "kind", ["id"])

    def fail(*a, **k):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(S, "publish_bytes", fail) if step == "publish" else m.setattr(Committed, step, fail)
        with pytest.raises(OSError):
            table.replace_run(frame(spark, NEW), run, "kind", ["id"])
    new = sorted(NEW if run == "first" else OLD + NEW, key=repr)
    assert rows_of(table) == (new if step == "_clean" else sorted(OLD, key=repr))
    table.replace_run(frame(spark, NEW), run, "kind", ["id"])  # the retry
    assert rows_of(table) == new
    # what the failed try left is gone, and the folder holds what counts
    left = {f for r in ("first", run) for f in table._listed(f"run_id={r}")}
    assert left == set(table.files())
    keys = table.existing_keys(frame(spark, NEW).schema, ["id"], frame(spark, OLD))
    assert sorted(r.id for r in keys.collect()) == sorted(r[0] for r in new)


def test_delete_rewrites_only_files_with_a_match(spark, scratch):
    table = Committed(spark, f"{scratch}/t")
    table.replace_run(frame(spark, OLD), "a", "kind", ["id"])
    table.replace_run(frame(spark, [(100, None, "x"), (101, "n1", "q")]), "b", "kind", ["id"])
    before, schema = set(table.files()), frame(spark, OLD).schema
    gone = F.col("name").isin("n1", "n4") & (F.col("kind") == "y")
    done = table.delete(schema, gone, "kind", ["id"])
    assert done["rows"] == 2 and done["files"] >= 1
    after = set(table.files())
    assert {f for f in before if "kind=y" not in f} <= after and len(before - after) == done["files"]
    assert rows_of(table) == sorted([r for r in OLD if r[1] not in ("n1", "n4")] + [(100, None, "x"), (101, "n1", "q")], key=repr)
    assert {f for r in "ab" for f in table._listed(f"run_id={r}")} == after
    keys = table.existing_keys(schema, ["id"], frame(spark, OLD))
    assert {r.id for r in keys.collect()} & {1, 4} == set()  # a deleted key is free again
    assert table.delete(schema, gone, "kind") == {"files": 0, "rows": 0} and set(table.files()) == after
    assert table.delete(schema, F.lit(True), "kind")["rows"] == 12 and rows_of(table) == []


def test_a_failed_delete_changes_nothing(spark, scratch, monkeypatch):
    table, schema = Committed(spark, f"{scratch}/t"), frame(spark, OLD).schema
    table.replace_run(frame(spark, OLD), "a")
    with monkeypatch.context() as m:
        m.setattr(Committed, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.delete(schema, F.col("id") < 3)
    assert rows_of(table) == sorted(OLD, key=repr)
    assert table.delete(schema, F.col("id") < 3)["rows"] == 3 and rows_of(table) == sorted(OLD[3:], key=repr)


def test_writers_that_meet(spark, scratch, monkeypatch):
    table, schema = Committed(spark, f"{scratch}/t"), frame(spark, OLD).schema
    table.replace_run(frame(spark, OLD), "a")
    base = table.manifest()
    table.replace_run(frame(spark, NEW), "b")
    with pytest.raises(CommitConflict):
        table._commit(base, {})
    stale = table.manifest()
    # another run commits while rows are deleted: both changes hold
    with monkeypatch.context() as m:
        real, seen = Committed.manifest, []

        def behind(self):
            seen.append(1)
            return base if len(seen) == 1 else real(self)
        m.setattr(Committed, "manifest", behind)
        table.delete(schema, F.col("id") == 2)
    assert rows_of(table) == sorted([r for r in OLD if r[0] != 2] + NEW, key=repr)
    # the same run was rewritten meanwhile: nothing is committed
    with monkeypatch.context() as m:
        seen = []

        def behind(self):
            seen.append(1)
            return stale if len(seen) == 1 else real(self)
        m.setattr(Committed, "manifest", behind)
        m.setattr(Committed, "_scan", lambda self, schema, files, extra: real_scan(
            self, schema, [f for f in files if os.path.exists(f"{self.path}/{f}")], extra))
        with pytest.raises(StaleRewrite):
            table.delete(schema, F.col("id") == 3)
    assert rows_of(table) == sorted([r for r in OLD if r[0] != 2] + NEW, key=repr)


real_scan = Committed._scan


def test_folders_without_a_manifest_are_taken_over(spark, scratch):
    table, schema = Committed(spark, f"{scratch}/t"), frame(spark, OLD).schema
    assert not table.exists() and rows_of(table) == [] and table.delete(schema, F.lit(True)) == {"files": 0, "rows": 0}
    assert table.existing_keys(schema, ["id"], frame(spark, OLD)).count() == 0
    frame(spark, OLD).write.parquet(f"{scratch}/t/run_id=old")
    assert rows_of(table) == sorted(OLD, key=repr)
    assert table.existing_keys(schema, ["id"], frame(spark, OLD)).count() == 12  # not indexed: the rows themselves
    table.replace_run(frame(spark, NEW), "new", keys=["id"])
    assert rows_of(table) == sorted(OLD + NEW, key=repr) and rows_of(table, without="old") == sorted(NEW, key=repr)
    assert rows_of(table, only="old") == sorted(OLD, key=repr)
    assert table.existing_keys(schema, ["id"], frame(spark, OLD), without="old").count() == 5


SCHEMA = ("seq int, patient_name string, medical_condition string, billing_amount decimal(18,2), "
          "admission_date date, discharge_date date")


def test_a_second_load_reads_the_index_not_the_table(spark, scratch, monkeypatch):
    d = [dt.date(2024, 1, k + 1) for k in range(9)]
    first = [(i, f"p{i}", "c", D("10.00"), d[i % 9], d[8]) for i in range(60)] + [(61, "n", "c", D("1"), None, d[0])]
    batch = [(1, "p3", "x", D("1"), d[3], d[8]), (2, "p3", "x", D("1"), d[4], d[8]), (3, "n", "x", D("1"), None, d[0]),
             (4, "z", "x", D("1"), d[0], d[8])]
    rules, log = L.Constraints(checks=(L.Constraints.billing_range(),)), ErrorLog(spark, f"{scratch}/log")
    frames = [spark.createDataFrame(x, SCHEMA) for x in (first, batch)]
    L.run_constrained_load(frames[0], rules, ["seq"], f"{scratch}/t", log, run_id="one")
    table = Committed(spark, f"{scratch}/t")
    existing = table.existing_keys(frames[1].schema, list(rules.unique), frames[1], without="two")
    read = existing.inputFiles()
    assert read and all("/_keys/" in f for f in read)
    assert len(read) < len(frames[0].inputFiles() or table._listed("_keys/run_id=one") or [1] * 64)  # its own buckets only
    seen = []
    label = L.label_batch
    monkeypatch.setattr(L, "label_batch", lambda b, e, *a: seen.append(e.inputFiles()) or label(b, e, *a))
    got = L.run_constrained_load(frames[1], rules, ["seq"], f"{scratch}/t", log, run_id="two")
    assert got == {"rows": 4, "accepted": 2, "rejected": 2} and all("/_keys/" in f for f in seen[0])
    want = L.load_constrained(frames[1], frames[0], rules, ["seq"]).accepted
    mine = table.read(frames[1].schema, only="two")
    assert sorted(map(repr, mine.collect())) == sorted(map(repr, want.collect()))
    assert L.run_constrained_load(frames[1], rules, ["seq"], f"{scratch}/t", log, run_id="two") == got
    assert table.read(frames[1].schema).count() == 63 and log.read().count() == 2
