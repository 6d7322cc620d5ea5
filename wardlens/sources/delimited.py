"""Delimited text sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wardlens.schema import ADMISSIONS_FILE


def read_delimited(spark: SparkSession, path: str, schema: StructType = ADMISSIONS_FILE, sep: str = ";",
                   header: bool = True, corrupt_column: str | None = "_corrupt_record") -> DataFrame:
    """Header row skipped, declared schema, no inference.

    PERMISSIVE mode keeps malformed lines: their fields are NULL and the raw line is kept in
    ``corrupt_column`` so a loader can route it to the error log instead of failing.
    """
    if corrupt_column and corrupt_column not in schema.fieldNames():
        schema = StructType(schema.fields + [StructField(corrupt_column, StringType(), True)])
    reader = (spark.read.schema(schema).option("header", header).option("sep", sep)
              .option("mode", "PERMISSIVE"))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(path)


def read_admissions_csv(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """The operational bulk load: ';' separated, header, every field as declared text."""
    return read_delimited(spark, path, ADMISSIONS_FILE, sep=sep)


def write_delimited(df: DataFrame, path: str, sep: str = ";", drop: list[str] | None = None) -> None:
    """S3: header, no index, helper columns dropped; one part file per task (no single writer)."""
    if drop:
        df = df.drop(*drop)
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
