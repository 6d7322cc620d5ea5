"""The constrained loader on a file stream: each micro-batch is routed like a batch load and
rows of earlier epochs count as existing for the UNIQUE rule."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from wardlens.operators import load as L
from wardlens.operators.errorlog import ErrorLog
from wardlens.streaming.loader import stream_constrained_load, stream_typed_load

SCHEMA = ("seq int, patient_name string, medical_condition string, billing_amount decimal(18,2), "
          "admission_date date, discharge_date date")


def test_stream_constrained_load(spark, scratch):
    src = f"{scratch}/incoming"
    d = dt.date(2024, 1, 1)
    spark.createDataFrame([(1, "Ann", "x", D("10.00"), d, d), (2, "Ann", "y", D("11.00"), d, d),
                           (3, "Bob", "x", D("999999.00"), d, d)], SCHEMA).coalesce(1).write.parquet(f"{src}/b1")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    rules = L.Constraints(checks=(L.Constraints.billing_range(0, 150000),))
    q = stream_constrained_load(spark, stream, f"{scratch}/target", f"{scratch}/log", f"{scratch}/ckpt", rules, ["seq"])
    q.awaitTermination(120)
    target = spark.read.parquet(f"{scratch}/target")
    assert [(r.patient_name, r.medical_condition) for r in target.collect()] == [("Ann", "x")]
    log = ErrorLog(spark, f"{scratch}/log").read().collect()
    assert len(log) == 2 and all(r.process_context.startswith("Scenario 5") for r in log)

    # a second batch: Ann's key now exists in the target
    spark.createDataFrame([(4, "Ann", "z", D("12.00"), d, d), (5, "Cy", "x", D("1.00"), d, d)], SCHEMA) \
        .coalesce(1).write.parquet(f"{src}/b2")
    q = stream_constrained_load(spark, spark.readStream.schema(SCHEMA).parquet(f"{src}/*"), f"{scratch}/target",
                                f"{scratch}/log", f"{scratch}/ckpt", rules, ["seq"])
    q.awaitTermination(120)
    names = sorted(r.patient_name for r in spark.read.parquet(f"{scratch}/target").collect())
    assert names == ["Ann", "Cy"]


def test_stream_typed_load(spark, scratch):
    src = f"{scratch}/staging"
    spark.createDataFrame([("a", "1.50"), ("b", "$2")], "name string, billing_amount string").write.parquet(src)
    q = stream_typed_load(spark, spark.readStream.schema("name string, billing_amount string").parquet(src),
                          f"{scratch}/t", f"{scratch}/l", f"{scratch}/c", key_col="name")
    q.awaitTermination(120)
    assert [r.name for r in spark.read.parquet(f"{scratch}/t").collect()] == ["a"]
    assert ErrorLog(spark, f"{scratch}/l").read().count() == 1


def test_stream_load_partitioned_target(spark, scratch):
    src = f"{scratch}/incoming"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    spark.createDataFrame([(1, "Ann", "x", D("10.00"), d1, d1), (2, "Bob", "x", D("1.00"), d2, d2),
                           (3, "Nul", "x", D("1.00"), None, d2)], SCHEMA).coalesce(1).write.parquet(f"{src}/b1")
    rules = L.Constraints(checks=(L.Constraints.billing_range(0, 150000),))
    run = lambda: stream_constrained_load(
        spark, spark.readStream.schema(SCHEMA).parquet(f"{src}/*"), f"{scratch}/target", f"{scratch}/log",
        f"{scratch}/ckpt", rules, ["seq"], partition_col="admission_date").awaitTermination(120)
    run()
    spark.createDataFrame([(4, "Ann", "z", D("12.00"), d1, d1), (5, "Nul", "y", D("2.00"), None, d2),
                           (6, "Cy", "x", D("1.00"), d2, d2)], SCHEMA).coalesce(1).write.parquet(f"{src}/b2")
    run()
    target = spark.read.parquet(f"{scratch}/target")
    assert sorted((r.patient_name, r.medical_condition) for r in target.collect()) == [
        ("Ann", "x"), ("Bob", "x"), ("Cy", "x"), ("Nul", "x")]
