"""Typed lookup (FIXTURES section 5), layout, generators (section 7), skewed distribution."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from wardlens.operators import layout as Y
from wardlens.operators import lookup as K
from wardlens.plans import reports as R
from wardlens.sources import generate as G


def accounts(spark, scratch):
    df = G.gen_transactions(spark, n=2000, seed=7, as_of="2024-12-31")
    fixed = spark.createDataFrame(
        [(90001, "123456", dt.date(2024, 1, 1), None, "Deposit", "Cleared"),
         (90002, "0123456", dt.date(2024, 1, 1), None, "Deposit", "Cleared"),
         (90003, "AB1", dt.date(2024, 1, 1), None, "Deposit", "Cleared")], df.schema)
    path = f"{scratch}/transactions"
    generated = df.filter(~F.col("account_number").isin("123456", "0123456", "AB1"))
    generated.unionByName(fixed).write.parquet(path)
    return spark.read.parquet(path)


def test_typed_lookup_exact_text_and_pushdown(spark, scratch):
    df = accounts(spark, scratch)
    got = K.typed_lookup(df, "account_number", 123456)
    assert [r.account_number for r in got.collect()] == ["123456"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(account_number,123456)" in plan


def test_naive_lookup_changes_the_answer(spark, scratch):
    df = accounts(spark, scratch)
    # the column is cast for every row: 'AB1' cannot become a number
    with pytest.raises(Exception):
        K.naive_lookup(df, "account_number", 123456).collect()
    sub = df.filter(F.col("account_number").isin("123456", "0123456"))
    assert sub.filter(F.col("account_number") == F.lit(123456)).count() == 2  # '0123456' = 123456 numerically


def test_audit_lookup(spark, scratch):
    df = accounts(spark, scratch)
    f = K.audit_lookup(spark, df, "account_number", 123456, "regulatory_transactions").collect()
    assert len(f) == 1 and f[0].value_type == "bigint" and f[0].column_type == "string"
    assert K.audit_lookup(spark, df, "account_number", "123456").count() == 0


def test_audit_compares_type_families(spark):
    df = spark.createDataFrame([], "i int, d decimal(18,2), x double, t date, ts timestamp, s string, b boolean")
    day = dt.date(2024, 1, 1)
    fine = [("i", 5), ("i", 2.5), ("d", D("1.00")), ("d", 3), ("x", 1), ("t", day), ("ts", dt.datetime(2024, 1, 1)),
            ("s", "5"), ("b", True)]
    assert all(K.audit_lookup(spark, df, c, v).isEmpty() for c, v in fine)
    wrong = [("s", 5), ("s", D("5")), ("s", day), ("i", "5"), ("t", "2024-01-01"), ("b", 1), ("i", True)]
    assert all(K.audit_lookup(spark, df, c, v).count() == 1 for c, v in wrong)


def test_numbers_in_text_columns_keep_their_digits(spark):
    texts = ["0.0000123456789", "0.000012", "12.31", "100000000000000000", "-0.5"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for value, want in ((1.23456789e-05, texts[0]), (12.31, "12.31"), (1e17, texts[3]), (-0.5, "-0.5"), (D("0.000012"), texts[1])):
        assert [r.v for r in K.typed_lookup(df, "v", value).collect()] == [want]


def test_transaction_generator(spark):
    df = G.gen_transactions(spark, n=10000, seed=42, as_of="2024-12-31")
    s = df.agg(F.min("amount"), F.max("amount"), F.min(F.length("account_number")), F.max(F.length("account_number")),
               F.min("transaction_date"), F.max("transaction_date"), F.count_distinct("transaction_type"),
               F.count_distinct("status")).first()
    assert float(s[0]) >= 1000 and float(s[1]) <= 50999 and s[2] == s[3] == 6
    assert s[4] >= dt.date(2024, 1, 2) and s[5] <= dt.date(2024, 12, 31) and s[6] == 3 and s[7] == 2
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, G.gen_transactions(spark, 10000, 42, "2024-12-31").collect()))


def test_skewed_generator_and_distribution(spark):
    df = G.gen_skewed_admissions(spark)
    dist = {r.admission_type: (r.row_count, r.pct_of_total) for r in R.value_distribution(df, "admission_type").collect()}
    assert dist == {"Emergency": (9500, D("95.00")), "Elective": (400, D("4.00")), "Urgent": (100, D("1.00"))}
    assert dict(R.value_distribution(df, "admission_type").dtypes)["pct_of_total"] == "decimal(5,2)"
    el = df.filter("admission_type = 'Elective'").agg(F.min("billing_amount"), F.max("billing_amount"),
                                                       F.count_distinct("medical_condition"), F.min("patient_name")).first()
    assert float(el[0]) >= 3000 and float(el[1]) <= 32999 and el[2] == 1 and el[3] == "Patient 1"
    em = df.filter("admission_type = 'Emergency'").groupBy("medical_condition").count().collect()
    assert {r.medical_condition for r in em} == {"Cancer", "Diabetes", "Obesity"}
    assert min(r["count"] for r in em) > 2900  # uniform classes (trap T19)
    by_type = R.admissions_by_type(df.withColumnRenamed("patient_name", "name"), "Urgent")
    assert by_type.count() == 100


def test_layout_prunes_and_reports_health(spark, scratch):
    df = G.gen_skewed_admissions(spark)
    path = f"{scratch}/sniff"
    Y.write_layout(df, path, partition_by=("admission_type",), sort_by=("medical_condition",), target_files=4)
    q = spark.read.parquet(path).filter((F.col("admission_type") == "Urgent") & (F.col("medical_condition") == "Asthma"))
    assert q.count() == 100
    ev = Y.scan_evidence(q)
    assert ev["input_files"] >= 1 and any("PartitionFilters" in s and "Urgent" in s for s in ev["scan"])
    health = {r.partition.rsplit("/", 1)[-1]: r for r in Y.layout_health(spark, path).collect()}
    assert set(health) == {"admission_type=Emergency", "admission_type=Elective", "admission_type=Urgent"}
    assert all(r.recommended_action == "REBUILD recommended" for r in health.values())  # all files are small


def test_point_lookups_skip_files_by_either_column(spark, scratch):
    import pyarrow.parquet as pq
    rows = [(i, f"{(i * 7919) % 4000:05d}.{i % 100:02d}", i % 3) for i in range(4000)] + [(None, None, 1), (5, None, 2), (7, "", 3)]
    df = spark.createDataFrame(rows, "id bigint, amount string, k int").repartition(5)
    path = f"{scratch}/lookup"
    Y.write_point_lookup_layout(df, path, "id", "amount", files=16)
    table = spark.read.parquet(path)
    files = [f.removeprefix("file://") for f in table.inputFiles()]
    assert sorted(map(repr, table.collect())) == sorted(map(repr, df.collect())) and len(files) >= 12
    spans = {}
    for f in files:
        meta = pq.ParquetFile(f).metadata
        columns = {meta.schema.column(c).name: c for c in range(meta.num_columns)}
        for name in ("id", "amount"):
            stats = [meta.row_group(g).column(columns[name]).statistics for g in range(meta.num_row_groups)]
            spans.setdefault(name, []).append((min(s.min for s in stats), max(s.max for s in stats)))
    for name, value in (("id", 1234), ("amount", rows[1234][1])):
        hit = sum(lo <= value <= hi for lo, hi in spans[name])
        assert 1 <= hit <= len(files) // 2, (name, hit)  # min/max alone skip half of the files or more
        got = K.typed_lookup(table, name, value)
        assert [r.id for r in got.collect()] == [1234]
        assert "EqualTo(" + name in got._jdf.queryExecution().executedPlan().toString()
    Y.write_point_lookup_layout(df.limit(0), f"{scratch}/none", "id", "amount", files=4)
    assert spark.read.schema(df.schema).parquet(f"{scratch}/none").count() == 0


def test_rebuild_compacts_marked_folders_only(spark, scratch):
    from wardlens.sources.committed import Committed
    df = spark.range(6000).selectExpr("id", "case when id % 20 = 0 then 'rare' else 'often' end kind", "repeat(cast(id as string), 20) text")
    table, schema = Committed(spark, f"{scratch}/t"), df.schema
    table.replace_run(df.filter("kind = 'often'").repartition(9), "a", "kind")
    table.replace_run(df.filter("kind = 'rare'").coalesce(1), "b", "kind", ["id"])
    before = set(table.files())
    small = 40_000
    health = {r.partition: r for r in Y.table_health(table, schema, small).collect()}
    assert set(health) == {"run_id=a/kind=often", "run_id=b/kind=rare"}
    assert health["run_id=a/kind=often"].files == 9 and health["run_id=a/kind=often"].recommended_action.startswith("REBUILD")
    size = health["run_id=a/kind=often"].bytes
    done = Y.rebuild(table, schema, ["id"], "kind", target_bytes=size // 2, small_file_bytes=small)
    assert done == {"folders": 1, "files": 9}
    after = set(table.files())
    assert {f for f in before if "kind=rare" in f} <= after and len(after) <= 4  # a folder of one file stays as it is
    assert sorted(map(tuple, table.read(schema).collect())) == sorted(map(tuple, df.collect()))
    again = {r.partition: r.recommended_action for r in Y.table_health(table, schema, 20_000).collect()}
    assert again["run_id=a/kind=often"].startswith("OK")
    assert Y.rebuild(table, schema, ["id"], "kind", small_file_bytes=20_000) == {"folders": 0, "files": 0}
    assert table.existing_keys(schema, ["id"], df).filter("id % 20 = 0").count() == 300  # the other run keeps its index


def test_health_of_paths_with_odd_names(spark, scratch):
    from wardlens.sources.committed import Committed
    df = spark.createDataFrame([(1, "a b"), (2, "x+y"), (3, "50%"), (4, None)], "id int, kind string")
    table = Committed(spark, f"{scratch}/odd dir")
    table.replace_run(df, "r 1", "kind")
    assert {f.file for f in table.file_sizes(df.schema).collect()} == set(table.files())
    assert table.delete(df.schema, F.col("kind") == "x+y", "kind") == {"files": 1, "rows": 1}
    assert sorted((r.id, r.kind) for r in table.read(df.schema).collect()) == [(1, "a b"), (3, "50%"), (4, None)]


def test_the_pieces_of_the_rebuilt_layout_grow_with_its_rows():
    from wardlens.plans import storage
    assert storage._small_pieces(0) == storage._small_pieces(600_000) == 12
    for rows in (36_000_000, 216_000_000, 10 ** 10 + 1):
        assert rows / storage._small_pieces(rows) <= storage.PIECE_ROWS
