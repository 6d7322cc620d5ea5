"""Seeded synthetic generators for tests and demos; distributed over
``spark.range`` with hash-based randomness, so a rerun gives the same rows on any cluster.

Each random draw is one materialised column (``pmod(xxhash64(id, seed, salt), n)``), so a CASE
over it cannot be re-evaluated per branch and skew the classes (trap T19)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def seeded_int(id_col: Column, seed: int, salt: str, n: int) -> Column:
    """Uniform integer in [0, n) from the row id, a seed and a salt."""
    return F.pmod(F.xxhash64(id_col, F.lit(seed), F.lit(salt)), F.lit(n))


def pick(idx: Column, values) -> Column:
    """Simple CASE idx WHEN 0 THEN v0 ... as an array lookup."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


# Transaction types and statuses of the reference's generator.
TRANSACTION_TYPES = ("Deposit", "Withdrawal", "Transfer")
STATUSES = ("Cleared", "Pending")


def gen_transactions(spark: SparkSession, n: int = 10000, seed: int = 42, as_of: str = "2024-12-31") -> DataFrame:
    """Account 100000..999999 as text, date as_of-0..364, amount 1000..50999, 3 types, 2 statuses."""
    i = F.col("id")
    return spark.range(n).select(
        (i + 1).alias("transaction_id"),
        (seeded_int(i, seed, "acct", 900000) + 100000).cast("string").alias("account_number"),
        F.date_sub(F.lit(as_of).cast("date"), seeded_int(i, seed, "date", 365).cast("int")).alias("transaction_date"),
        (seeded_int(i, seed, "amount", 50000) + 1000).cast("decimal(18,2)").alias("amount"),
        pick(seeded_int(i, seed, "type", 3), TRANSACTION_TYPES).alias("transaction_type"),
        pick(seeded_int(i, seed, "status", 2), STATUSES).alias("status"),
    )


# The skewed admissions of the parameter-sensitivity scenario:
# class -> (rows, conditions, billing low, billing span).
SKEWED_CLASSES = (
    ("Emergency", 9500, ("Cancer", "Diabetes", "Obesity"), 5000, 50000),
    ("Elective", 400, ("Arthritis",), 3000, 30000),
    ("Urgent", 100, ("Asthma",), 2000, 20000),
)


def gen_skewed_admissions(spark: SparkSession, classes=SKEWED_CLASSES, seed: int = 42, as_of: str = "2024-12-31",
                          scale: int = 1) -> DataFrame:
    """One class per contiguous id range; names 'Patient n' restart at 1 in each class."""
    total = sum(c[1] for c in classes) * scale
    i = F.col("id")
    cls = cond = low = span = start = None
    offset = 0
    for name, rows, conditions, lo, sp in classes:
        rows *= scale
        in_cls = (i >= offset) & (i < offset + rows)
        c_pick = pick(seeded_int(i, seed, "cond", len(conditions)), conditions)
        cls = F.when(in_cls, F.lit(name)) if cls is None else cls.when(in_cls, F.lit(name))
        cond = F.when(in_cls, c_pick) if cond is None else cond.when(in_cls, c_pick)
        low = F.when(in_cls, F.lit(lo)) if low is None else low.when(in_cls, F.lit(lo))
        span = F.when(in_cls, F.lit(sp)) if span is None else span.when(in_cls, F.lit(sp))
        start = F.when(in_cls, F.lit(offset)) if start is None else start.when(in_cls, F.lit(offset))
        offset += rows
    return spark.range(total).select(
        (i + 1).alias("admission_id"),
        F.concat(F.lit("Patient "), (i - start + 1).cast("string")).alias("patient_name"),
        cond.alias("medical_condition"), cls.alias("admission_type"),
        (F.pmod(F.xxhash64(i, F.lit(seed), F.lit("bill")), span) + low).cast("decimal(18,2)").alias("billing_amount"),
        F.date_sub(F.lit(as_of).cast("date"), seeded_int(i, seed, "date", 365).cast("int")).alias("admission_date"),
    )
