"""Table scans, sinks and table maintenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The driver's table names.
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Expose the driver tables as temp views for SQL."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def drop_table(spark: SparkSession, name: str) -> None:
    """DROP TABLE IF EXISTS (scratch tables of tests and of the hierarchy walk)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(spark: SparkSession, schema: StructType | str, data: list) -> DataFrame:
    """Inline literal relation (VALUES)."""
    return spark.createDataFrame(data, schema)


def materialise(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """CREATE OR REPLACE TABLE AS SELECT, as parquet at ``path``; returns the rescanned table."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def append_to(df: DataFrame, path: str, mapping: dict[str, str] | None = None) -> None:
    """INSERT ... SELECT with column renaming (source -> target)."""
    if mapping:
        df = df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])
    df.write.mode("append").parquet(path)


def row_count(df: DataFrame, alias: str = "total_rows") -> DataFrame:
    """COUNT(*) as a one-row DataFrame (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that survive ``DELETE ... WHERE predicate`` (NULL predicate keeps the row)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def describe_columns(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type) pairs, read from the schema; no job runs."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def profile(df: DataFrame, distinct: bool | str = True) -> DataFrame:
    """Per column: type, non-null count, null count and (``distinct``) the HyperLogLog++ distinct
    count. One aggregate over the table: partial counts per task, no row is shuffled. ``distinct="exact"`` counts the
    distinct values themselves, still in one scan: each column's values are counted per task and shuffled by value."""
    fields = df.schema.fields
    if distinct == "exact":
        return _exact_profile(df)
    names = ["non_null", "null_count"] + (["distinct_values"] if distinct else [])
    aggs = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count(c).alias(f"non_null_{i}"), F.count_if(c.isNull()).alias(f"null_count_{i}")]
        if distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"distinct_values_{i}"))
    wide = df.agg(*aggs)
    parts = [", ".join([f"'{f.name}'", f"'{f.dataType.simpleString()}'", *(f"{n}_{i}" for n in names)])
             for i, f in enumerate(fields)]
    return wide.select(F.expr(f"stack({len(parts)}, {', '.join(parts)}) as (column_name, data_type, {', '.join(names)})"))


def _exact_profile(df: DataFrame) -> DataFrame:
    cells = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                      F.col(f"`{f.name}`").cast("string").alias("value"), F.lit(1).cast("bigint").alias("n")) for f in df.schema.fields]
    values = df.select(F.inline(F.array(*cells)))
    none = df.sparkSession.createDataFrame([(c, t, None, 0) for c, t in describe_columns(df)], values.schema)  # an empty table has columns
    counts = values.unionByName(none).groupBy("column_name", "data_type", "value").agg(F.sum("n").alias("n"))
    given = F.col("value").isNotNull()
    return counts.groupBy("column_name", "data_type").agg(
        F.sum(F.when(given, F.col("n")).otherwise(0)).alias("non_null"), F.sum(F.when(~given, F.col("n")).otherwise(0)).alias("null_count"),
        F.count("value").alias("distinct_values"))
