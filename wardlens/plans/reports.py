"""The reporting API. Every report takes the cleaned admissions
DataFrame and returns a DataFrame; column roles are keyword arguments.

Money averages, shares and cost per day are exact half-up (see functions.numeric); counts are
bigint; ranks are bigint; stays are int days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.dates import between_dates, stay_days
from wardlens.functions.numeric import (
    RATIO_SCALE, cents, exact_round, exact_trunc, money_avg_rounded, pct, pct_decimal, ratio_avg,
    safe_number,
)
from wardlens.operators.numbering import total_order
from wardlens.operators.ranking import labelled_counts, rank_within, share_of_total, share_within, top_n


def _by(*keys: str) -> list:
    """Sort keys, nulls last; a leading minus is descending. Reports end their keys with a full tie-break."""
    return [F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last() for k in keys]


def _stay(start="admission_date", end="discharge_date"):
    return stay_days(start, end)


def average_stay(df: DataFrame, mode: str = "exact") -> DataFrame:
    """Q1: average length of stay; ``exact`` (fractional) or ``truncated`` (integer average)."""
    s = _stay()
    total, n = F.sum(s), F.count(s)
    if mode == "exact":
        value = F.when(n > 0, total.cast("double") / n.cast("double"))
    elif mode == "truncated":
        value = exact_trunc(total, n)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.agg(value.alias("avg_stay"))


def longest_stays(df: DataFrame, n: int = 100, hospital: str = "hospital") -> DataFrame:
    """Q2: the n longest stays; ties broken by every output column so the rows kept are fixed."""
    out = df.select("name", "medical_condition", hospital, _stay().alias("stay_length"))
    order = [F.col("stay_length").desc_nulls_last(), F.col("name").asc_nulls_last(),
             F.col("medical_condition").asc_nulls_last(), F.col(hospital).asc_nulls_last()]
    return top_n(out, order, n)


def monthly_report(df: DataFrame, year: int) -> DataFrame:
    """Q3: admissions, average bill and abnormal results per month of one year.

    The filter is a plain date range on the raw column, so it reaches the parquet scan (and
    prunes partitions when the table is laid out by date); ``year(date) = y`` would not."""
    f = df.filter(between_dates("admission_date", f"{year}-01-01", f"{year}-12-31"))
    return (f.groupBy(F.year("admission_date").alias("year"), F.month("admission_date").alias("month"))
             .agg(F.count(F.lit(1)).alias("admissions"),
                  money_avg_rounded("billing_amount").alias("avg_billing"),
                  F.count_if(F.col("test_results") == "Abnormal").alias("abnormal_results"))
             .orderBy("year", "month"))


def monthly_admissions(df: DataFrame) -> DataFrame:
    """Admissions per year and month over all time."""
    return (df.groupBy(F.year("admission_date").alias("year"), F.month("admission_date").alias("month"))
              .agg(F.count(F.lit(1)).alias("admissions"))
              .orderBy(*_by("year", "month")))


def admission_peaks(df: DataFrame) -> DataFrame:
    """The busiest and the quietest month over all time (earliest month on ties): two minima over the
    monthly rows, with partial aggregation."""
    monthly = (df.groupBy(F.year("admission_date").alias("year"), F.month("admission_date").alias("month"))
                 .agg(F.count(F.lit(1)).alias("admissions")))
    best = monthly.agg(F.min(F.struct((-F.col("admissions")).alias("k"), "year", "month", "admissions")).alias("b"),
                       F.min(F.struct(F.col("admissions").alias("k"), "year", "month", "admissions")).alias("q"))
    peaks = F.array(F.struct(F.lit("Busiest month").alias("peak"), F.col("b").alias("m")),
                    F.struct(F.lit("Quietest month").alias("peak"), F.col("q").alias("m")))
    return (best.filter(F.col("b").isNotNull()).select(F.explode(peaks).alias("p"))
                .select("p.peak", "p.m.year", "p.m.month", "p.m.admissions"))


def cases_by_gender(df: DataFrame) -> DataFrame:
    """Cases per gender and condition."""
    return (_gender_counts(df).orderBy(*_by("-total_cases", "gender", "medical_condition")))


def _gender_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("gender", "medical_condition").agg(F.count(F.lit(1)).alias("total_cases"))


def top_conditions_by_gender(df: DataFrame, top: int = 3) -> DataFrame:
    """Q4: top conditions per gender with their share of that gender's admissions.

    The share is of all the gender's cases: the totals come from the counts, not from the ranked rows."""
    counts = _gender_counts(df)
    shared = share_within(counts, "gender", "total_cases", out_col="pct_of_gender_admissions")
    ranked = rank_within(shared, "gender", "total_cases", top=top, rank_col="condition_rank")
    return ranked.select("gender", "medical_condition", "total_cases", "condition_rank",
                         "pct_of_gender_admissions").orderBy(*_by("gender", "condition_rank", "medical_condition"))


def medication_by_condition(df: DataFrame) -> DataFrame:
    """Q5: prescriptions per condition and medication with the female share."""
    female = F.count_if(F.col("gender") == "Female")
    n = F.count(F.lit(1))
    return (df.groupBy("medical_condition", "medication")
              .agg(n.alias("prescription_count"), female.alias("female_prescriptions"),
                   pct(female, n).alias("female_percentage"))
              .orderBy(*_by("medical_condition", "-prescription_count", "medication")))


def hospital_condition_summary(df: DataFrame, hospital: str = "hospital") -> DataFrame:
    """Q6: cases, average bill and average stay (1 dp) per hospital and condition; NULL keys dropped."""
    s = _stay()
    return (df.filter(F.col(hospital).isNotNull() & F.col("medical_condition").isNotNull())
              .groupBy(hospital, "medical_condition")
              .agg(F.count(F.lit(1)).alias("total_cases"),
                   money_avg_rounded("billing_amount").alias("avg_billing"),
                   exact_round(F.sum(s), F.count(s), 1).alias("avg_stay_days"))
              .orderBy(*_by(hospital, "-total_cases", "medical_condition")))


def top_conditions_by_hospital(df: DataFrame, top: int = 3, hospital: str = "hospital") -> DataFrame:
    """Q7: top conditions per hospital (ties kept); NULL hospitals dropped."""
    counts = (df.filter(F.col(hospital).isNotNull())
                .groupBy(hospital, "medical_condition").agg(F.count(F.lit(1)).alias("cases")))
    return rank_within(counts, hospital, "cases", top=top, rank_col="condition_rank").orderBy(
        *_by(hospital, "condition_rank", "medical_condition"))


def cost_by_condition_hospital(df: DataFrame, hospital: str = "hospital") -> DataFrame:
    """Q8: average bill, average cost per day (zero stays drop out) and zero-stay count.

    NULL hospitals are kept here, unlike Q6/Q7 (trap T14)."""
    parts = _per_stay(df, ["medical_condition", hospital])
    return (parts.groupBy("medical_condition", hospital)
                 .agg(exact_round(F.sum("_cents"), F.sum("_bills") * F.lit(100), 2).alias("avg_total_bill"),
                      ratio_avg("_cents", "_stay", "_bills", 2).alias("avg_cost_per_day"),
                      F.coalesce(F.sum(F.when(F.col("_stay") == 0, F.col("_rows"))), F.lit(0)).alias("zero_stay_anomalies"))
                 .orderBy(*_by("-avg_cost_per_day", "medical_condition", hospital)))


def _per_stay(df: DataFrame, keys: list[str]) -> DataFrame:
    """Exact sums per key and length of stay: rows, bills and cents. An average of ratios is then rounded once, not
    per row."""
    return df.groupBy(*keys, _stay().alias("_stay")).agg(
        F.count(F.lit(1)).alias("_rows"), F.count("billing_amount").alias("_bills"),
        F.sum(cents("billing_amount")).alias("_cents"))


def busiest_hospitals(df: DataFrame, n: int = 5, ascending: bool = False, hospital: str = "hospital") -> DataFrame:
    """Q9: the n hospitals with most (or fewest) cases."""
    counts = df.groupBy(hospital).agg(F.count(F.lit(1)).alias("cases"))
    first = F.col("cases").asc_nulls_last() if ascending else F.col("cases").desc_nulls_last()
    return top_n(counts, [first, F.col(hospital).asc_nulls_last()], n)


def condition_by_type(df: DataFrame, hospital_value: str, hospital: str = "hospital") -> DataFrame:
    """Q10: condition x admission type for one hospital (an equality filter pushed to the scan)."""
    return (df.filter(F.col(hospital) == F.lit(hospital_value))
              .groupBy("medical_condition", "admission_type").agg(F.count(F.lit(1)).alias("frequency"))
              .orderBy(*_by("admission_type", "-frequency", "medical_condition")))


def results_by_type(df: DataFrame) -> DataFrame:
    """Q11: test results by admission type with the share of all rows."""
    counts = df.groupBy("admission_type", "test_results").agg(F.count(F.lit(1)).alias("total"))
    return share_of_total(counts, "total", "percentage_of_total").orderBy(
        *_by("test_results", "-total", "admission_type"))


def cost_band(col="billing_amount", lo: float = 20000, hi: float = 40000):
    """> hi High; lo..hi Medium; everything else, NULL included, Low (trap T13)."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.when(c > F.lit(hi), "High Cost").when(c.between(F.lit(lo), F.lit(hi)), "Medium Cost")
             .otherwise("Low Cost"))


def cost_bands(df: DataFrame, lo: float = 20000, hi: float = 40000) -> DataFrame:
    """Q12: cases per admission type and cost band."""
    return (df.groupBy("admission_type", cost_band("billing_amount", lo, hi).alias("cost_category"))
              .agg(F.count(F.lit(1)).alias("cases"))
              .orderBy(*_by("admission_type", "cost_category")))


def result_category(col="test_results"):
    c = F.col(col) if isinstance(col, str) else col
    return (F.when(c == "Abnormal", "Requires Attention").when(c == "Normal", "Stable").otherwise("Inconclusive"))


def result_categories(df: DataFrame) -> DataFrame:
    """Q13: admissions per result category; NULL results count as Inconclusive."""
    return df.groupBy(result_category().alias("result_category")).agg(F.count(F.lit(1)).alias("total_cases"))


def gender_counts(df: DataFrame) -> DataFrame:
    """Q14: Male and Female admissions, one scan; a label with no rows shows 0."""
    g = F.col("gender")
    return labelled_counts(df, {"Male": g == "Male", "Female": g == "Female"}, "gender_group", "admissions")


def emergency_vs_elective(df: DataFrame) -> DataFrame:
    """Q15: Emergency and Elective admissions, one scan."""
    t = F.col("admission_type")
    return labelled_counts(df, {"Emergency Admissions": t == "Emergency", "Elective Admissions": t == "Elective"},
                           "category", "total")


def billing_vs_daily_cost(df: DataFrame) -> DataFrame:
    """Q16: average bill and average cost per day, one scan, two rows. Both are exact sums divided once;
    the cost per day is given to 12 decimals (a double holds no more of it)."""
    bill = F.when(F.sum("_bills") > 0, F.sum("_cents").cast("double") / (F.sum("_bills") * F.lit(100)).cast("double"))
    return labelled_counts(_per_stay(df, []), {"Average Billing": None, "Average Cost Per Day": None}, "metric", "value",
                           value_exprs={"Average Billing": bill,
                                        "Average Cost Per Day": ratio_avg("_cents", "_stay", "_bills", RATIO_SCALE)})


def hospital_count(df: DataFrame, hospital: str = "hospital", approx: bool = False) -> DataFrame:
    """Q17: number of distinct hospitals (``approx`` uses HyperLogLog++ for very large inputs)."""
    fn = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(fn(hospital).alias("number_of_hospitals"))


def billing_preview(df: DataFrame, n: int = 5, col: str = "billing_amount", order: list[str] | None = None) -> DataFrame:
    """Q18: a few rows of a text column with the safe conversion next to the raw value. Which rows is
    undefined, unless ``order`` says so."""
    rows = df.orderBy(*order).limit(n) if order else df.limit(n)
    return rows.select(F.col(col), safe_number(col, "double").alias("safe_billing"))


def billing_summary(df: DataFrame) -> DataFrame:
    """Q19: per condition, AVG(bill) and SUM(bill) / COUNT(*) (rows with no bill count in the
    second denominator only), both at 6 decimals."""
    s = F.sum(cents("billing_amount"))
    return (df.groupBy("medical_condition")
              .agg(exact_round(s, F.count("billing_amount") * F.lit(100), 6).alias("avg_billing"),
                   exact_round(s, F.count(F.lit(1)) * F.lit(100), 6).alias("avg_billing_per_case")))


def filtered_summary(df: DataFrame, admission_type: str = "Emergency", condition: str = "Cancer",
                     hospital: str = "hospital") -> DataFrame:
    """Q20: the regulatory report: one type and condition, per hospital; average stay truncated."""
    s = _stay()
    return (df.filter((F.col("admission_type") == admission_type) & (F.col("medical_condition") == condition))
              .groupBy(hospital, "medical_condition", "admission_type")
              .agg(F.count(F.lit(1)).alias("total_cases"),
                   exact_round(F.sum(cents("billing_amount")), F.count("billing_amount") * F.lit(100), 6)
                   .alias("avg_billing"),
                   exact_trunc(F.sum(s), F.count(s)).alias("avg_stay_days"))
              .orderBy(*_by("-total_cases", hospital, "medical_condition", "admission_type")))


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Q21: rows per value of a column with its share of all rows, decimal(5,2)."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return share_of_total(counts, "row_count", "pct_of_total", share=pct_decimal)


def admissions_by_type(df: DataFrame, admission_type: str, spread_copies: bool = False) -> DataFrame:
    """Q22: admissions of one type, newest first. The literal is typed like the column, so the
    equality reaches the scan as a pushed filter whatever the value's skew. The extra sort keys
    make the order total, and let the range partitioner split a date that holds many rows. ``spread_copies`` also
    splits a group of equal rows, for one more write of the rows (``numbering.total_order``)."""
    rows = df.filter(F.col("admission_type") == F.lit(admission_type)).select(
        F.col("name").alias("patient_name"), "medical_condition", "admission_type", "billing_amount", "admission_date")
    order = [F.col("admission_date").desc_nulls_last(), F.col("patient_name").asc_nulls_last(),
             F.col("medical_condition").asc_nulls_last(), F.col("billing_amount").asc_nulls_last()]
    return total_order(rows, order) if spread_copies else rows.orderBy(*order)
