"""Typed lookups.

Comparing a text column with a number makes Spark cast the *column* (every row), which both
loses the parquet pushdown and changes the answer ('0123456' = 123456 is true as numbers,
'AB1' raises under ANSI). The typed lookup converts the value to the column's type once, so
the comparison is a pushed-down ``EqualTo`` on the stored values.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the wording of the finding logged for a type mismatch, with slots.
MISMATCH_MESSAGE = ("Implicit conversion detected on {column} — {value_type} parameter passed to {column_type} column. "
                    "Fixed by aligning parameter type to {column_type}.")


# Spark types by the family in which a comparison converts no stored value to another kind.
_FAMILIES = {"tinyint": "number", "smallint": "number", "int": "number", "bigint": "number", "float": "number",
             "double": "number", "decimal": "number", "string": "string", "varchar": "string", "char": "string",
             "boolean": "boolean", "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
             "binary": "binary"}


def _spark_type_of(value) -> str:
    for kind, name in ((bool, "boolean"), (int, "bigint"), (float, "double"), (Decimal, "decimal"), (str, "string"),
                       (dt.datetime, "timestamp"), (dt.date, "date"), (bytes, "binary")):
        if isinstance(value, kind):
            return name
    return type(value).__name__


def _family(type_name: str) -> str:
    return _FAMILIES.get(type_name.split("(")[0], type_name)


def naive_lookup(df: DataFrame, column: str, value) -> DataFrame:
    """Equality with the value as given; kept only to show the mistyped case in tests."""
    return df.filter(F.col(column) == F.lit(value))


def typed_lookup(df: DataFrame, column: str, value) -> DataFrame:
    """Y2: ``column = CAST(value AS <column type>)``; a number searched in a text column is written out
    without exponent, with every digit of its shortest form."""
    dtype = df.schema[column].dataType
    lit = F.lit(value)
    if dtype.simpleString() == "string" and isinstance(value, (float, Decimal)):
        lit = F.lit(format(Decimal(repr(value)) if isinstance(value, float) else value, "f"))
    return df.filter(F.col(column) == lit.cast(dtype))


def audit_lookup(spark: SparkSession, df: DataFrame, column: str, value, table: str = "table") -> DataFrame:
    """One finding row when the parameter is of another type family than the column, else none.

    Reads only the schema (S15); the result feeds ``ErrorLog.finding``."""
    column_type = df.schema[column].dataType.simpleString()
    value_type = _spark_type_of(value)
    rows = []
    if _family(value_type) != _family(column_type):
        rows.append((f"{table}.{column}", column_type, value_type,
                     MISMATCH_MESSAGE.format(column=f"{table}.{column}", value_type=value_type,
                                             column_type=column_type)))
    return spark.createDataFrame(rows, "column_name string, column_type string, value_type string, message string")
