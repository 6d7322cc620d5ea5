"""Sources and sinks: ';' CSV round trip with declared schema, corrupt lines kept, profile."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from wardlens.operators.clean import parse_dates
from wardlens.schema import ADMISSIONS_FILE
from wardlens.sources import delimited, tables


def test_csv_round_trip_and_date_parsing(spark, scratch):
    rows = [("Ann Lee", 30, "Female", "A+", "Asthma", "5/1/2024", "Dr X", "Ins", D("1200.50"), 101, "Urgent",
             "07/01/2024", "M1", "Normal", "Smith Ltd"),
            ("Bo Li", 40, "Male", "O-", "Flu", "2024-02-01", "Dr Y", "Ins", None, 102, "Elective",
             "bad date", "M2", "Abnormal", None)]
    df = spark.createDataFrame(rows, ADMISSIONS_FILE)
    path = f"{scratch}/adm_csv"
    delimited.write_delimited(df.withColumn("helper", F.lit(1)), path, drop=["helper"])
    back = delimited.read_admissions_csv(spark, path)
    assert [r for r in back.collect() if r._corrupt_record is not None] == []
    parsed = {r.name: r for r in parse_dates(back.drop("_corrupt_record")).collect()}
    assert parsed["Ann Lee"].admission_date == dt.date(2024, 1, 5) and parsed["Ann Lee"].billing_amount == D("1200.50")
    assert parsed["Bo Li"].admission_date == dt.date(2024, 2, 1) and parsed["Bo Li"].discharge_date is None


def test_corrupt_lines_are_kept(spark, scratch):
    path = f"{scratch}/bad.csv"
    with open(path, "w") as fh:
        fh.write("name;age\nAnn;30\nBob;notanumber\n")
    df = delimited.read_delimited(spark, path, spark.createDataFrame([], "name string, age int").schema)
    rows = {r.name: r for r in df.collect()}
    assert rows["Ann"].age == 30 and rows["Ann"]._corrupt_record is None
    assert rows["Bob"].age is None and rows["Bob"]._corrupt_record == "Bob;notanumber"


def test_profile_and_maintenance(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, None)], "s string, n int")
    prof = {r.column_name: r for r in tables.profile(df, distinct=False).collect()}
    assert (prof["s"].non_null, prof["s"].null_count) == (2, 1) and "distinct_values" not in prof["s"].asDict()
    assert prof["n"].data_type == "int" and prof["n"].null_count == 2
    assert tables.describe_columns(df) == [("s", "string"), ("n", "int")]
    assert tables.row_count(df).first()[0] == 3
    assert tables.delete_where(df, F.col("s").isin("a")).count() == 2  # NULL predicate keeps the row
    out = tables.materialise(df, f"{scratch}/t")
    tables.append_to(df.select("s", "n"), f"{scratch}/t", {"s": "s", "n": "n"})
    assert out.count() == 3 and spark.read.parquet(f"{scratch}/t").count() == 6


def test_profile_approx_path(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, None)], "s string, n int")
    prof = {r.column_name: r for r in tables.profile(df).collect()}
    assert (prof["s"].non_null, prof["s"].null_count, prof["s"].distinct_values) == (2, 1, 2)


def test_scale_conf_sizes_shuffles():
    from wardlens.session import scale_conf
    big = scale_conf(100 * 10 ** 12)
    assert big["spark.sql.shuffle.partitions"] == "186265"  # at most 512 MB each
    assert scale_conf(10 ** 9)["spark.sql.shuffle.partitions"] == "8"
    assert scale_conf(64 * 512 * 1024 * 1024)["spark.sql.shuffle.partitions"] == "64"


def test_exact_profile(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (None, "b", None)], "i int, s string, n double")
    got = {r.column_name: tuple(r)[1:] for r in tables.profile(df, distinct="exact").collect()}
    assert got == {"i": ("int", 2, 1, 2), "s": ("string", 3, 0, 2), "n": ("double", 0, 3, 0)}
    assert {tuple(r)[2:] for r in tables.profile(df.limit(0), distinct="exact").collect()} == {(0, 0, 0)}
