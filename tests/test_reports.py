"""Report semantics on small literal tables: NULLs in ELSE branches (T13), NULL group keys
(T14), surviving zero labels (T12), rank ties (W1), exact shares (T1)."""

import datetime as dt
from decimal import Decimal as D

from wardlens.plans import reports as R

COLS = ("name string, gender string, medical_condition string, admission_date date, discharge_date date, "
        "billing_amount decimal(18,2), admission_type string, medication string, test_results string, hospital string")


def adm(spark):
    d = dt.date(2024, 1, 1)
    rows = [
        ("A", "Male", "Flu", d, dt.date(2024, 1, 3), D("45000.00"), "Emergency", "M1", "Abnormal", "Smith"),
        ("B", "Male", "Flu", d, dt.date(2024, 1, 2), D("30000.00"), "Emergency", "M1", "Normal", "Smith"),
        ("C", "Male", "Cold", d, d, D("100.00"), "Elective", "M2", None, None),
        ("D", "Male", "Cold", d, dt.date(2024, 1, 5), None, "Elective", "M2", "Inconclusive", "Jones"),
        ("E", "Male", "Gout", dt.date(2024, 12, 31), dt.date(2025, 1, 2), D("20000.00"), "Urgent", "M3", "Normal", "Jones"),
    ]
    return spark.createDataFrame(rows, COLS)


def test_null_falls_into_else(spark):
    bands = {(r.admission_type, r.cost_category): r.cases for r in R.cost_bands(adm(spark)).collect()}
    assert bands == {("Emergency", "High Cost"): 1, ("Emergency", "Medium Cost"): 1, ("Elective", "Low Cost"): 2,
                     ("Urgent", "Medium Cost"): 1}
    cats = {r.result_category: r.total_cases for r in R.result_categories(adm(spark)).collect()}
    assert cats == {"Requires Attention": 1, "Stable": 2, "Inconclusive": 2}


def test_zero_label_survives(spark):
    got = {r.gender_group: r.admissions for r in R.gender_counts(adm(spark)).collect()}
    assert got == {"Male": 5, "Female": 0}
    plan = R.gender_counts(adm(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") + plan.count("FileScan") == 1


def test_null_hospital_kept_only_in_cost_report(spark):
    df = adm(spark)
    assert None in {r.hospital for r in R.cost_by_condition_hospital(df).collect()}
    assert None not in {r.hospital for r in R.hospital_condition_summary(df).collect()}
    assert None not in {r.hospital for r in R.top_conditions_by_hospital(df).collect()}


def test_cost_per_day_drops_zero_stays(spark):
    rows = {(r.medical_condition, r.hospital): r for r in R.cost_by_condition_hospital(adm(spark)).collect()}
    assert rows[("Cold", None)].avg_cost_per_day is None and rows[("Cold", None)].zero_stay_anomalies == 1
    assert rows[("Flu", "Smith")].avg_cost_per_day == 26250.0  # (45000/2 + 30000/1) / 2
    assert rows[("Flu", "Smith")].avg_total_bill == 37500.0


def test_rank_ties_keep_more_than_top(spark):
    out = R.top_conditions_by_gender(adm(spark), top=1).collect()
    # Flu and Cold tie with 2 cases each: both rank 1
    assert sorted((r.medical_condition, r.condition_rank, r.pct_of_gender_admissions) for r in out) == [
        ("Cold", 1, 40.0), ("Flu", 1, 40.0)]


def test_monthly_report_includes_last_day(spark):
    rows = R.monthly_report(adm(spark), 2024).collect()
    assert sorted((r.month, r.admissions) for r in rows) == [(1, 4), (12, 1)]


def test_average_stay_modes(spark):
    assert R.average_stay(adm(spark)).first()[0] == 1.8          # (2+1+0+4+2)/5
    assert R.average_stay(adm(spark), mode="truncated").first()[0] == 1


def test_billing_summary_denominators(spark):
    rows = {r.medical_condition: r for r in R.billing_summary(adm(spark)).collect()}
    assert rows["Cold"].avg_billing == 100.0 and rows["Cold"].avg_billing_per_case == 50.0


def test_results_share_of_all_rows(spark):
    rows = R.results_by_type(adm(spark)).collect()
    assert sum(r.total for r in rows) == 5 and all(r.percentage_of_total == 20.0 for r in rows)


def test_busiest_and_lookup_reports(spark):
    top = [(r.hospital, r.cases) for r in R.busiest_hospitals(adm(spark), n=2).collect()]
    assert top == [("Jones", 2), ("Smith", 2)]
    assert R.condition_by_type(adm(spark), "Smith").collect()[0].frequency == 2
    assert R.filtered_summary(adm(spark), "Emergency", "Flu").first().avg_stay_days == 1
    assert [r.patient_name for r in R.admissions_by_type(adm(spark), "Elective").collect()] in (["C", "D"], ["D", "C"])


def test_countif_vs_sum_case_on_empty_input(spark):
    # A3: COUNTIF gives 0 on no rows, the T-SQL twin SUM(CASE ...) gives NULL
    from pyspark.sql import functions as F
    empty = adm(spark).filter("1 = 0")
    row = empty.agg(F.count_if(F.col("test_results") == "Abnormal").alias("c"),
                    F.sum(F.when(F.col("test_results") == "Abnormal", 1).otherwise(0)).alias("s")).first()
    assert (row.c, row.s) == (0, None)
    assert R.gender_counts(empty).collect()[0].admissions == 0


def test_small_helpers(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    from wardlens.functions import dates
    from wardlens.operators import load as L
    one = spark.range(1)
    assert one.select(dates.days_before("2024-12-31", 364)).first()[0] == dt.date(2024, 1, 2)
    assert one.select(dates.days_before(F.lit(dt.date(2024, 3, 1)), F.lit(1))).first()[0] == dt.date(2024, 2, 29)
    assert R.hospital_count(adm(spark), approx=True).first()[0] == 2
    diag = {r.patient_name: r.diagnosis for r in L.diagnose_zero_stay(adm(spark).withColumnRenamed("name", "patient_name")).collect()}
    assert diag["C"] == "ZERO STAY — will cause divide-by-zero" and diag["A"] == "Valid"
