"""Defensive loading goldens (FIXTURES.md sections 2-4, 9) and invariants."""

import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from wardlens.operators import load as L
from wardlens.operators.errorlog import ErrorLog, JobFailed, logged_job
from wardlens.operators.hierarchy import RecursionLimitExceeded
from wardlens.plans import reports as R
from wardlens.schema import BILLING_TEST, CONSTRAINED, STAGING

STAGING_ROWS = [
    ("John Smith", "Diabetes", "25000.50", "2024-01-01", "2024-01-05"),
    ("Jane Doe", "Cancer", "$NotANumber", "2024-02-01", "2024-02-10"),
    ("Bob Johnson", "Obesity", "31500.75", "2024-03-01", "2024-03-08"),
    ("Test Patient", "Arthritis", "N/A", "2024-04-01", "2024-04-03"),
]
EXTRA_STAGING = [("P5", "x", "12d", None, None), ("P6", "x", "NaN", None, None), ("P7", "x", "1e5", None, None),
                 ("P8", "x", "", None, None), ("P9", "x", " 12 ", None, None), ("P10", "x", None, None, None)]


def test_conversion_load_routes_bad_rows(spark):
    res = L.load_typed(spark.createDataFrame(STAGING_ROWS, STAGING), key_col="name")
    acc = {r.name: r.billing_amount for r in res.accepted.collect()}
    assert acc == {"John Smith": D("25000.50"), "Bob Johnson": D("31500.75")}
    rej = res.rejected.collect()
    assert sorted(r.process_context for r in rej) == [
        "Scenario 1 — Billing_Amount conversion failure: Jane Doe",
        "Scenario 1 — Billing_Amount conversion failure: Test Patient"]
    assert {r.error_number for r in rej} == {8114}


def test_conversion_load_extra_rows(spark):
    res = L.load_typed(spark.createDataFrame(EXTRA_STAGING, STAGING), key_col="name")
    assert {r.name: r.billing_amount for r in res.accepted.collect()} == {"P9": D("12.00"), "P10": None}
    assert res.rejected.count() == 4
    assert res.accepted.count() + res.rejected.count() == len(EXTRA_STAGING)


def test_conversion_strict_mode_fails(spark):
    res = L.load_typed(spark.createDataFrame(STAGING_ROWS, STAGING), key_col="name", on_error="fail")
    with pytest.raises(Exception):
        res.accepted.collect()


BILLING = [("Alice Brown", D("25000.00"), dt.date(2024, 1, 1), dt.date(2024, 1, 5)),
           ("Bob Clarke", D("18000.00"), dt.date(2024, 2, 1), dt.date(2024, 2, 1)),
           ("Carol Davies", D("31000.00"), dt.date(2024, 3, 1), dt.date(2024, 3, 8)),
           ("David Evans", D("22000.00"), dt.date(2024, 4, 1), dt.date(2024, 4, 1))]


def test_cost_per_day_zero_stays(spark):
    df = spark.createDataFrame(BILLING, BILLING_TEST)
    out = {r.patient_name: r for r in L.cost_per_day(df).collect()}
    assert out["Alice Brown"].cost_per_day == 6250.0 and out["Carol Davies"].cost_per_day == 4428.57
    assert out["Bob Clarke"].cost_per_day is None and out["Bob Clarke"].stay_days == 0
    assert out["Bob Clarke"].data_quality_flag == "Flagged — same day discharge, review source data"
    assert out["Alice Brown"].data_quality_flag == "Valid"
    short = {r.patient_name: r.data_quality_flag for r in L.cost_per_day(df, wording="short").collect()}
    assert short["David Evans"] == "Flagged — same day discharge"
    # average over the four rows: zero stays drop out -> (6250 + 31000/7) / 2
    avg = {r.metric: r.value for r in R.billing_vs_daily_cost(df).collect()}["Average Cost Per Day"]
    assert round(avg, 2) == 5339.29


def test_strict_division_fails(spark):
    df = spark.createDataFrame(BILLING, BILLING_TEST)
    with pytest.raises(Exception):
        df.select(F.col("billing_amount") / F.datediff("discharge_date", "admission_date")).collect()


EXISTING = [("Alice Brown", "Cancer", D("25000.00"), dt.date(2024, 1, 1), dt.date(2024, 1, 8)),
            ("Bob Clarke", "Diabetes", D("18000.00"), dt.date(2024, 1, 2), dt.date(2024, 1, 6)),
            ("Carol Davies", "Obesity", D("31000.00"), dt.date(2024, 1, 3), dt.date(2024, 1, 10))]
BATCH = [("David Evans", "Arthritis", D("22000.00"), dt.date(2024, 1, 4), dt.date(2024, 1, 7)),
         ("Alice Brown", "Cancer", D("25000.00"), dt.date(2024, 1, 1), dt.date(2024, 1, 8)),
         ("Frank Harris", "Asthma", D("999999.00"), dt.date(2024, 1, 5), dt.date(2024, 1, 6)),
         ("Grace Jones", "Diabetes", D("17000.00"), dt.date(2024, 1, 6), dt.date(2024, 1, 9))]


def rules():
    return L.Constraints(unique=("patient_name", "admission_date"), not_null=("patient_name",),
                         checks=(L.Constraints.billing_range(0, 150000),))


def with_seq(spark, rows):
    schema = "seq int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CONSTRAINED.fields)
    return spark.createDataFrame([(i,) + r for i, r in enumerate(rows)], schema)


def existing_df(spark):
    return spark.createDataFrame(EXISTING, CONSTRAINED)


def test_constrained_insert(spark):
    res = L.load_constrained(with_seq(spark, BATCH), existing_df(spark).withColumn("seq", F.lit(-1)), rules(), ["seq"])
    assert sorted(r.patient_name for r in res.accepted.collect()) == ["David Evans", "Grace Jones"]
    rej = {r.patient_name: r.reason for r in res.rejected.collect()}
    assert rej == {"Alice Brown": L.DUPLICATE_EXISTING, "Frank Harris": "CHECK violation: billing_amount between 0 and 150000"}
    assert existing_df(spark).count() + res.accepted.count() == 5


def test_violation_report(spark):
    v = L.violations(with_seq(spark, BATCH), existing_df(spark), rules()).collect()
    assert sorted((r.patient_name, r.violation_type) for r in v) == [
        ("Alice Brown", "DUPLICATE — violates UQ_patient_admission"),
        ("Frank Harris", "BILLING OUT OF RANGE — violates CHK_billing_range")]


def test_violation_report_null_keys_and_both_rules(spark):
    d = dt.date(2024, 5, 1)
    existing = spark.createDataFrame([("A", "x", D("1.00"), None, d), ("B", "x", D("1.00"), d, d), ("B", "y", D("1.00"), d, d)],
                                     CONSTRAINED)
    batch = with_seq(spark, [("A", "x", D("1.00"), None, d), ("B", "x", D("999999.00"), d, d), ("C", "x", D("-1.00"), d, d)])
    got = sorted((r.patient_name, r.violation_type.split(" ")[0]) for r in L.violations(batch, existing, rules()).collect())
    assert got == [("B", "BILLING"), ("B", "DUPLICATE"), ("C", "BILLING")]  # a NULL date never equals a NULL date


def test_atomic_insert_rejects_everything(spark):
    with pytest.raises(ValueError):
        L.load_constrained(with_seq(spark, BATCH), existing_df(spark), rules(), ["seq"], on_error="atomic")


def test_adversarial_rows(spark):
    d = dt.date(2024, 5, 1)
    rows = [("Hank", "x", D("999999.00"), d, d),   # range violation ...
            ("Hank", "x", D("10.00"), d, d),       # ... does not reserve the key: accepted
            ("Ivy", "x", D("1.00"), d, d), ("Ivy", "y", D("2.00"), d, d),    # first wins
            ("Jo", "x", D("1.00"), None, d), ("Jo", "y", D("1.00"), None, d),  # NULL dates are equal keys
            ("Kim", "x", None, d, d),              # NULL amount passes CHECK
            (None, "x", D("1.00"), d, d),          # NULL name rejected
            ("Lu", "x", D("5.00"), d, d), ("Lu", "x", D("5.00"), d, d), ("Lu", "x", D("5.00"), d, d)]  # copies
    batch = with_seq(spark, rows).withColumn("seq", F.when(F.col("patient_name") == "Lu", 99).otherwise(F.col("seq")))
    res = L.load_constrained(batch, existing_df(spark).withColumn("seq", F.lit(-1)), rules(), ["seq"])
    acc = sorted((r.patient_name, r.medical_condition, str(r.billing_amount)) for r in res.accepted.collect())
    assert acc == [("Hank", "x", "10.00"), ("Ivy", "x", "1.00"), ("Jo", "x", "1.00"), ("Kim", "x", "None"),
                   ("Lu", "x", "5.00")]
    rej = res.rejected.collect()
    assert len(rej) + res.accepted.count() == len(rows)  # accepted + rejected = input, row by row
    lu = [r for r in rej if r.patient_name == "Lu"]
    assert len(lu) == 2 and {r.reason for r in lu} == {L.DUPLICATE_BATCH}
    logged = L.rejected_log_rows(res.rejected, "patient_name", "r").collect()
    assert len(logged) == len(rej) == len({r.error_id for r in logged})
    assert sum(r.process_context == "Scenario 5 — constraint violation: Lu" for r in logged) == 2
    assert any(r.patient_name is None and r.reason == "NOT NULL violation: patient_name" for r in rej)


def test_run_load_writes_target_and_log(spark, scratch):
    log = ErrorLog(spark, f"{scratch}/error_log")
    target = f"{scratch}/admissions_constrained"
    existing_df(spark).withColumn("seq", F.lit(-1)).write.parquet(f"{target}/run_id=initial")
    for _ in range(3):  # a retry reads the unfiltered target: its own rows do not count as existing
        stats = L.run_constrained_load(with_seq(spark, BATCH), rules(), ["seq"], target, log, run_id="r1")
        assert stats == {"rows": 4, "accepted": 2, "rejected": 2}
        assert spark.read.parquet(target).count() == 5
        found = log.search("%Scenario 5%").collect()
        assert len(found) == 2 and all(r.error_datetime is not None for r in found)
        numbers = {r.process_context.split(": ")[1]: r.error_number for r in found}
        assert numbers == {"Alice Brown": 2627, "Frank Harris": 547}
    again = L.run_constrained_load(with_seq(spark, BATCH), rules(), ["seq"], target, log, run_id="r2")
    assert again == {"rows": 4, "accepted": 0, "rejected": 4}  # another run: all keys are taken
    assert spark.read.parquet(target).count() == 5 and log.read().count() == 6


def test_an_unreadable_target_fails_the_load(spark, scratch):
    target = f"{scratch}/broken/run_id=old"
    os.makedirs(target)
    with open(f"{target}/part-0.parquet", "w") as f:
        f.write("no parquet file")
    log = ErrorLog(spark, f"{scratch}/broken_log")
    with pytest.raises(Exception):
        L.run_constrained_load(with_seq(spark, BATCH), rules(), ["seq"], f"{scratch}/broken", log, run_id="r1")
    assert not os.path.exists(f"{scratch}/broken/run_id=r1") and log.read().count() == 0


def test_two_bad_rows_of_one_patient_have_their_own_ids(spark):
    rows = [(1, "Ann", "x"), (2, "Ann", "y")]
    staging = spark.createDataFrame(rows, "id int, name string, billing_amount string")
    rejected = L.load_typed(staging, key_col="id").rejected.collect()
    assert len({r.error_id for r in rejected}) == 2


def test_run_typed_load_is_idempotent(spark, scratch):
    log = ErrorLog(spark, f"{scratch}/error_log")
    staging = spark.createDataFrame(STAGING_ROWS, STAGING)
    for _ in range(2):
        stats = L.run_typed_load(staging, f"{scratch}/t", log, key_col="name", run_id="nightly-1")
    assert stats == {"rows": 4, "accepted": 2, "rejected": 2}
    assert spark.read.parquet(f"{scratch}/t").count() == 2
    assert log.read().count() == 2


def test_logged_job_and_findings(spark, scratch):
    log = ErrorLog(spark, f"{scratch}/error_log")
    df = spark.createDataFrame(BILLING, BILLING_TEST)
    with pytest.raises(JobFailed) as info:
        with logged_job(log, "usp_generate_billing_summary", "Nightly billing summary job"):
            df.groupBy("patient_name").agg((F.sum("billing_amount") / F.lit(0)).alias("x")).collect()
    assert info.value.number == 50001
    with pytest.raises(JobFailed):
        with logged_job(log, "strict_load", "Nightly load"):
            L.load_typed(spark.createDataFrame(STAGING_ROWS, STAGING), key_col="name", on_error="fail").accepted.collect()
    with pytest.raises(JobFailed):
        with logged_job(log, "walk", "Chain"):
            raise RecursionLimitExceeded("first line\nsecond line")
    by = {r.error_procedure: r for r in log.read().collect()}
    assert by["strict_load"].error_number == 8114 and by["walk"].error_number == 530
    assert by["walk"].error_message == "first line\nsecond line"
    log.finding("Implicit conversion detected", "Scenario 6 — implicit conversion investigation")
    rows = log.search().collect()
    assert len(rows) == 4
    failed = [r for r in rows if r.error_procedure == "usp_generate_billing_summary"][0]
    assert failed.error_number == 8134 and failed.error_severity == 16
    assert log.search("%Scenario 6%", ["error_id", "error_message"]).count() == 1


def test_conversion_load_with_dates(spark):
    rows = STAGING_ROWS + [("Bad Date", "x", "10.00", "31/02/2024", "2024-03-01"), ("Day First", "x", "1.00", "5/1/2024", None)]
    res = L.load_typed(spark.createDataFrame(rows, STAGING),
                       {"billing_amount": "decimal(18,2)", "admission_date": "date", "discharge_date": "date"}, key_col="name")
    acc = {r.name: r for r in res.accepted.collect()}
    assert set(acc) == {"John Smith", "Bob Johnson", "Day First"}
    assert str(acc["Day First"].admission_date) == "2024-01-05" and acc["Day First"].discharge_date is None
    assert res.rejected.count() == 3
    with pytest.raises(Exception):
        L.load_typed(spark.createDataFrame(rows[-2:], STAGING), {"admission_date": "date"}, key_col="name", on_error="fail").accepted.collect()


def test_a_batch_is_written_once_before_it_is_labelled(spark, scratch, monkeypatch):
    rows = [(i, f"P{i % 7}", float(i * 900)) for i in range(40)] + [(50, None, 1.0), (50, None, 1.0)]
    batch = spark.createDataFrame(rows, "k int, patient_name string, billing_amount double").withColumn(
        "admission_date", F.lit("2024-01-01").cast("date"))
    rules = L.Constraints(checks=(L.Constraints.billing_range(0, 20000),))
    written, cut = [], L.cut_lineage
    monkeypatch.setattr(L, "cut_lineage", lambda df: written.append(df.columns) or cut(df))
    got = L.run_constrained_load(batch, rules, ["k"], f"{scratch}/t", L.ErrorLog(spark, f"{scratch}/log"))
    assert got == {"rows": 42, "accepted": 7, "rejected": 35}
    assert len(written) == 2  # the batch, and the labelled batch
    monkeypatch.undo()
    empty = batch.limit(0)
    assert sorted(L.label_batch(L.written(batch), empty, rules, ["k"]).drop("row_tag").collect(), key=str) == sorted(
        L.label_batch(batch, empty, rules, ["k"]).drop("row_tag").collect(), key=str)
