"""Stand-in admissions data derived by Spark from the driver's TPC-H-style tables.

The reference works on one flat admissions table whose file is not published. This module maps
the given tables onto that schema (SURVEY section 5), so every report runs over whole tables and
its work grows with them: one admission per ``lineitem`` row.

The same mapping is written once more as DuckDB SQL in :mod:`wardlens.plans.oracle`; the two
must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.sources.tables import read_table


# Columns of an admission by the table they come from; the rest come from the line itself.
_FROM = {"customer": {"name"}, "part": {"medical_condition", "medication", "hospital"},
         "orders": {"name", "admission_date", "discharge_date", "admission_type"}}


def _lines(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    """lineitem joined to those of order, customer and part that the wanted columns need (one row per
    line, no fan-out: each is found by its key, and every line has one).

    At scale every side here is large (customer and part grow with the data too), so the joins
    are left to AQE: it broadcasts a side only when its runtime size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise keeps a shuffle join, splitting
    skewed partitions.
    """
    out = read_table(spark, sf_dir, "lineitem")
    if wanted & _FROM["orders"]:
        o = read_table(spark, sf_dir, "orders")
        out = out.join(o, out.l_orderkey == o.o_orderkey)
    if wanted & _FROM["customer"]:
        c = read_table(spark, sf_dir, "customer")
        out = out.join(c, out.o_custkey == c.c_custkey)
    if wanted & _FROM["part"]:
        p = read_table(spark, sf_dir, "part")
        out = out.join(p, out.l_partkey == p.p_partkey)
    return out


def _admission_columns(wanted: set[str]) -> list:
    pk = F.col("l_partkey")
    adm = F.to_date("o_orderdate")
    hospital = (F.when(pk % 11 == 0, F.lit(None).cast("string"))
                 .when(pk % 4 == 0, F.concat("p_name", F.lit(" Ltd")))
                 .when(pk % 4 == 1, F.concat("p_name", F.lit(", and Sons")))
                 .when(pk % 4 == 2, F.concat(F.lit("Group "), "p_name"))
                 .otherwise(F.concat("p_name", F.lit(","))))
    ck = F.col("c_custkey") % 3
    columns = [
        F.when(ck == 0, F.upper("c_name")).when(ck == 1, F.lower("c_name")).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("l_linestatus") == "O", "Male").otherwise("Female").alias("gender"),
        F.when(pk % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("medical_condition"),
        adm.alias("admission_date"),
        F.date_add(adm, F.col("l_quantity").cast("int") % 31).alias("discharge_date"),
        F.when(F.col("l_orderkey") % 23 == 0, F.lit(None).cast("decimal(18,2)"))
         .otherwise(F.col("l_extendedprice").cast("decimal(18,2)")).alias("billing_amount"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Urgent")
         .when(F.col("o_orderpriority") == "2-HIGH", "Emergency").otherwise("Elective").alias("admission_type"),
        F.col("p_brand").alias("medication"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
         .when(F.col("l_returnflag") == "A", "Abnormal")
         .when(F.col("l_returnflag") == "N", "Normal").otherwise("Inconclusive").alias("test_results"),
        hospital.alias("hospital"),
    ]
    return [c for name, c in zip(ADMISSION_COLUMNS, columns, strict=True) if name in wanted]


ADMISSION_COLUMNS = ("name", "gender", "medical_condition", "admission_date", "discharge_date",
                     "billing_amount", "admission_type", "medication", "test_results", "hospital")


def admissions(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = ADMISSION_COLUMNS) -> DataFrame:
    """Raw admissions: messy name casing, decorated hospital names, some NULLs. Tables that none of the
    ``columns`` needs are not read."""
    wanted = set(columns)
    return _lines(spark, sf_dir, wanted).select(*_admission_columns(wanted))


def admission_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw admissions plus the source line keys, for the loading scenarios.

    ``line_status`` splits the data into what is already loaded ('F', finished lines) and the
    incoming batch ('O', open lines); (order_key, line_number) gives an arrival order.
    """
    wanted = set(ADMISSION_COLUMNS)
    return _lines(spark, sf_dir, wanted).select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_number"),
        F.col("l_linestatus").alias("line_status"), *_admission_columns(wanted))


def billing_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text staging batch (all columns strings) built from ``events``.

    Every tenth amount carries a currency sign, which a strict numeric conversion rejects.
    """
    ev = read_table(spark, sf_dir, "events")
    c = F.round(F.col("value") * 100).cast("bigint")
    amount = F.format_string("%d.%02d", F.call_function("div", c, F.lit(100)), c % 100)
    day = F.to_date("ts")
    return ev.select(
        F.col("event_id").alias("staging_id"),
        F.concat(F.lit("Patient "), F.col("user_id").cast("string")).alias("name"),
        F.col("event_type").alias("medical_condition"),
        F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("$"), amount)).otherwise(amount).alias("billing_amount"),
        F.date_format(day, "yyyy-MM-dd").alias("admission_date"),
        F.date_format(F.date_add(day, (F.col("event_id") % 7).cast("int")), "yyyy-MM-dd").alias("discharge_date"),
    )


def referrals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Referral chains from ``conversations``: each turn is referred from the previous turn.

    Key (conv_id, turn); parent (conv_id, turn - 1); turn 0 is the root. The role plays the
    department.
    """
    cv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    parent = cv.select(F.col("conv_id").alias("p_conv"), F.col("turn").alias("p_turn"),
                       F.col("role").alias("from_department"))
    child = cv.withColumn("parent_turn", F.when(F.col("turn") > 0, F.col("turn") - 1))
    # (conv_id, turn) is unique, so this equi-join has no hot key.
    linked = child.join(parent, (child.conv_id == parent.p_conv) & (child.parent_turn == parent.p_turn), "left")
    return linked.select(
        "conv_id", "turn",
        F.concat(F.lit("Conversation "), F.col("conv_id").cast("string")).alias("patient_name"),
        "from_department",
        F.col("role").alias("to_department"),
        "parent_turn",
    )
