"""Cleaning operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.dates import DATE_FORMATS, parse_date
from wardlens.functions.numeric import MONEY, safe_number
from wardlens.functions.text import FIRST_TOKEN_STOPWORDS, first_token, initcap_name, title_case


def parse_dates(df: DataFrame, columns=("admission_date", "discharge_date"), formats=DATE_FORMATS) -> DataFrame:
    """Replace text date columns by DATE values; text that no layout accepts becomes NULL."""
    for c in columns:
        df = df.withColumn(c, parse_date(c, formats))
    return df


def unparsed_dates(df: DataFrame, columns=("admission_date", "discharge_date"), formats=DATE_FORMATS) -> DataFrame:
    """Per text date column, how many non-NULL values no accepted layout parses (one pass)."""
    aggs = []
    for i, c in enumerate(columns):
        aggs.append(F.count_if(F.col(c).isNotNull() & parse_date(c, formats).isNull()).alias(f"u{i}"))
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"m{i}"))
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', u{i}, m{i}" for i, c in enumerate(columns))
    return wide.select(F.expr(f"stack({len(columns)}, {parts}) as (column_name, unparsed, missing)"))


def clean_names(df: DataFrame, col: str = "name", style: str = "initcap") -> DataFrame:
    """Name casing; ``initcap`` (words between blanks and punctuation) or ``title`` (Python str.title)."""
    fn = {"initcap": initcap_name, "title": title_case}[style]
    return df.withColumn(col, fn(col))


def first_token_entity(df: DataFrame, col: str = "hospital", stopwords=FIRST_TOKEN_STOPWORDS,
                       out_col: str | None = None) -> DataFrame:
    """C4: warehouse hospital rule (first non-stopword letter token; NULL if none)."""
    return df.withColumn(out_col or col, first_token(col, stopwords))


def clean_warehouse(df: DataFrame, name: str = "name", hospital: str = "hospital",
                    name_style: str = "initcap") -> DataFrame:
    """The warehouse clean table: every other column unchanged, then the cased name and the
    first-token hospital appended last (``* EXCEPT (Name, Hospital), INITCAP(Name), token``).
    ``name_style="title"`` cases names like Python's ``str.title`` instead. A projection without one of
    the two columns stays without it."""
    rest = [c for c in df.columns if c not in (name, hospital)]
    cased = {"initcap": initcap_name, "title": title_case}[name_style]
    return df.select(*rest, *([cased(name).alias(name)] if name in df.columns else []),
                     *([first_token(hospital).alias(hospital)] if hospital in df.columns else []))


def null_check(df: DataFrame, columns=("hospital", "name"), total_col: str = "total_rows") -> DataFrame:
    """C11/C14: NULL count per column plus the row count, in one pass."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    return df.agg(*aggs, F.count(F.lit(1)).alias(total_col))


def distinct_before_after(raw: DataFrame, clean: DataFrame, col: str = "hospital",
                          labels=("Raw hospital distinct count", "Clean hospital distinct count")) -> DataFrame:
    """Distinct count of a column before and after cleaning, as labelled rows.

    Two inputs, so two aggregates joined by a union; each is a partial + final aggregate."""
    a = raw.agg(F.count_distinct(col).alias("value")).select(F.lit(labels[0]).alias("metric"), "value")
    b = clean.agg(F.count_distinct(col).alias("value")).select(F.lit(labels[1]).alias("metric"), "value")
    return a.unionByName(b)


def distinct_change(df: DataFrame, before, after,
                    labels=("Raw hospital distinct count", "Clean hospital distinct count")) -> DataFrame:
    """C12 in one pass when the clean value is an expression of the raw row: both distinct
    counts come from a single scan."""
    wide = df.agg(F.count_distinct(before).alias("b"), F.count_distinct(after).alias("a"))
    return wide.select(F.expr(f"stack(2, '{labels[0]}', b, '{labels[1]}', a) as (metric, value)"))


# Fixed value: the diagnosis wording of the quality report.
CONVERSION_FAILED = "CONVERSION FAILED — investigate source row"


def conversion_issues(df: DataFrame, col: str = "billing_amount", dtype: str = MONEY,
                      keep=("name", "medical_condition"), extra=("admission_date", "discharge_date"),
                      only_problems: bool = True) -> DataFrame:
    """Rows whose value is NULL or fails conversion, with the converted value and a flag.

    ``only_problems=False`` gives the diagnosis over every row."""
    converted = safe_number(col, dtype)
    out = df.select(*keep, F.col(col).alias("raw_value"), converted.alias("safe_value"),
                    F.when(converted.isNull(), CONVERSION_FAILED).otherwise("Valid").alias("quality_flag"),
                    *extra)
    if only_problems:
        out = out.filter(F.col("safe_value").isNull() | F.col("raw_value").isNull())
    return out

