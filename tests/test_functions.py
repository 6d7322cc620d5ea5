"""Scalar functions: safe conversion (T3), exact half-up rounding (T1), safe division (T4),
title case (T8), the two hospital-name rules (T9/T10), date parsing (T5/T6)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardlens.functions import dates, numeric, text


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def test_safe_number_rejects_what_sql_rejects(spark):
    vals = ["25000.50", "$NotANumber", "N/A", "12d", "NaN", "1e5", "", " 12 ", None, "-3.5", ".5", "7."]
    got = [r[0] for r in one_col(spark, vals).select(numeric.safe_number("v")).collect()]
    assert got == [Decimal("25000.50"), None, None, None, None, None, None, Decimal("12.00"), None,
                   Decimal("-3.50"), Decimal("0.50"), Decimal("7.00")]


def test_strict_number_fails_the_job(spark):
    df = one_col(spark, ["1.00", "$2"]).select(numeric.strict_number("v"))
    with pytest.raises(Exception):
        df.collect()


@pytest.mark.parametrize("num,den,scale,expected", [
    (1005, 1000, 2, 1.01),     # 1.005 -> 1.01 (a double would give 1.0 on some engines)
    (-1005, 1000, 2, -1.01),   # half away from zero
    (1, 3, 2, 0.33), (2, 3, 2, 0.67), (5, 2, 0, 3.0), (-5, 2, 0, -3.0), (7, 0, 2, None),
])
def test_exact_round(spark, num, den, scale, expected):
    df = spark.createDataFrame([(num, den)], "n long, d long")
    assert df.select(numeric.exact_round("n", "d", scale)).first()[0] == expected


def test_money_average_exact_ties(spark):
    # two rows averaging to half a cent: 10.00 and 10.01 -> 10.005 -> 10.01
    df = spark.createDataFrame([(Decimal("10.00"),), (Decimal("10.01"),), (None,)], "b decimal(18,2)")
    assert df.agg(numeric.money_avg_rounded("b")).first()[0] == 10.01


def test_safe_ratio_and_strict_ratio(spark):
    df = spark.createDataFrame([(10, 0), (10, 4)], "a int, b int")
    assert [r[0] for r in df.select(numeric.safe_ratio("a", "b")).collect()] == [None, 2.5]
    with pytest.raises(Exception):
        df.select(numeric.strict_ratio("a", "b")).collect()


def test_title_case_matches_python(spark):
    samples = ["o'neil-SMITH", "jOHN sMITH", "mary-jane o'brien", "x1y2 z", "", "  lead  space", "ÉLODIE dupont"]
    got = [r[0] for r in one_col(spark, samples + [None]).select(text.title_case("v")).collect()]
    assert got == [s.title() for s in samples] + [None]


def test_initcap_breaks_on_blanks_and_punctuation(spark):
    assert one_col(spark, ["a.b_c-d/e (f) [g] x+y", None, ""]).select(text.initcap_name("v")).collect()[0][0] == (
        "A.B_C-D/E (F) [G] X+Y")
    texts = ["o'NEIL-smith\x01 jr.x", "ÉCOLE d'été", "  two  BLANKS ", "tab\tNEW\nline", "#9a~b", "\\x|Y<z>", "-", "x" * 5000]
    df = one_col(spark, texts)
    assert [r[0] for r in df.select(text.initcap_name("v")).collect()] == [
        r[0] for r in df.select(text._cased_runs("v", text.INITCAP_BREAKS)).collect()]
    assert one_col(spark, ["o'neil-SMITH jr"]).select(text.initcap_name("v")).first()[0] == "O'neil-Smith Jr"


def test_first_token_rule(spark):
    vals = ["Smith Ltd", "LLC Smith", "Smith and Sons,", "Smith Jones Group", "and LLC, 9", None, "Group of Ltd Inc"]
    got = [r[0] for r in one_col(spark, vals).select(text.first_token("v")).collect()]
    assert got == ["Smith", "Smith", "Smith", "Smith", None, None, "of"]


def test_anchor_tokens_and_signature(spark):
    df = one_col(spark, ["Smith Jones Group", "and LLC, 9", None, "The Smith-Jones co"])
    toks = [r[0] for r in df.select(text.anchor_tokens("v")).collect()]
    assert toks == [["smith", "jones"], [], None, ["smith", "jones"]]
    sig = [r[0] for r in df.select(text.token_signature("v")).collect()]
    assert sig == ["jones smith", "", None, "jones smith"]


def test_strip_trailing(spark):
    got = [r[0] for r in one_col(spark, ["Smith,,", "a,b", None]).select(text.strip_trailing("v")).collect()]
    assert got == ["Smith", "a,b", None]


def test_parse_date_layouts(spark):
    got = [r[0] for r in one_col(spark, ["1/2/2024", "01/02/2024", "2024-02-01", "31/02/2024", "junk", None])
           .select(dates.parse_date("v")).collect()]
    assert got == [dt.date(2024, 2, 1)] * 3 + [None, None, None]


def test_between_dates_includes_last_day(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 31),), (dt.date(2025, 1, 1),)], "d date")
    assert df.filter(dates.between_dates("d", "2024-01-01", "2024-12-31")).count() == 1


def test_stay_days_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 5))], "a date, b date")
    assert df.select(dates.stay_days("a", "b")).first()[0] == 4


def test_no_python_udf_in_title_case_plan(spark):
    plan = one_col(spark, ["a"]).select(text.title_case("v"))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_unparsed_dates_report(spark):
    from wardlens.operators.clean import clean_warehouse, unparsed_dates
    df = spark.createDataFrame([("1/2/2024", None), ("31/02/2024", "2024-02-01"), ("junk", "x")], "admission_date string, discharge_date string")
    got = {r.column_name: (r.unparsed, r.missing) for r in unparsed_dates(df).collect()}
    assert got == {"admission_date": (2, 0), "discharge_date": (1, 1)}
    names = spark.createDataFrame([("o'neil-SMITH", "Smith Ltd")], "name string, hospital string")
    assert clean_warehouse(names, name_style="title").first().name == "O'Neil-Smith"


def test_ratio_average_equals_exact_fractions(spark):
    """Random signed sums over many denominators, ties and sums of fractions that make up whole numbers."""
    import random
    from fractions import Fraction
    rng, rows, want = random.Random(3), [], {}

    def add(group, parts):
        rows.extend((group, *p) for p in parts)
        used = [(c, d, n) for c, d, n in parts if d and c is not None]
        want[group] = (sum(Fraction(c, d) for c, d, _ in used) / 100 / sum(n for *_, n in used)) if used else None

    for g in range(300):
        days = rng.sample(range(1, 61), rng.randint(1, 25))
        add(g, [(rng.choice((-1, 1, 1)) * rng.randrange(10 ** rng.choice((1, 4, 18))), d, rng.randrange(1, 10 ** rng.choice((1, 3)))) for d in days])
    for g in range(300, 500):  # a tie of half a cent exactly, made of fractions; and just beside it
        days = rng.sample(range(2, 61), 12)
        cents = [rng.randrange(10 ** 9) for _ in days]
        short = -sum(Fraction(c, d) for c, d in zip(cents, days, strict=True)) % 1
        n = rng.choice((1, 3))
        add(g, [(c, d, n) for c, d in zip(cents, days, strict=True)] + ([(short.numerator, short.denominator, 1)] if short.denominator < 2**31 else [])
            + [(rng.choice((0, 50, 49, 51)), 1, 1)])
    add(500, [(None, 3, 0), (5, 0, 2), (7, None, 1)])
    add(501, [(1, -3, 1), (-1, 6, 2), (10, 7, 1)])
    add(502, [(-5, 10, 1)])  # half a cent below zero goes away from zero
    add(503, [(1, 3, 1), (2, 3, 1), (-1, 2, 2)])
    df = spark.createDataFrame([(g, None if c is None else Decimal(c), d, n) for g, c, d, n in rows], "g int, c decimal(38,0), d int, n bigint")
    for scale in (2, 12):
        got = {r.g: r.v for r in df.groupBy("g").agg(numeric.ratio_avg("c", "d", "n", scale).alias("v")).collect()}
        for g, v in want.items():
            if v is None:
                assert got[g] is None
                continue
            x = abs(v) * 10 ** scale
            units = (2 * x.numerator + x.denominator) // (2 * x.denominator)
            assert got[g] == (units if v >= 0 else -units) / float(10 ** scale), (g, v)
