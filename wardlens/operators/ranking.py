"""Analytic building blocks: rank within a group, share within a group or of the total,
top-n with full tie-breaks, labelled one-pass counts (SURVEY W1-W5, O1-O3, U1, A7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.functions.numeric import pct


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def rank_within(df: DataFrame, keys, metric: str, top: int | None = None, rank_col: str = "rank") -> DataFrame:
    """RANK() OVER (PARTITION BY keys ORDER BY metric DESC); ties share a rank and gaps follow,
    so ``top=3`` may keep more than three rows. Meant for already aggregated input: each
    window partition holds one group's rows. With ``top`` Catalyst adds a WindowGroupLimit
    before the shuffle, so only candidate rows move."""
    w = Window.partitionBy(*_cols(keys)).orderBy(F.col(metric).desc_nulls_last())
    out = df.withColumn(rank_col, F.rank().over(w).cast("bigint"))
    return out.filter(F.col(rank_col) <= top) if top is not None else out


def share_within(df: DataFrame, keys, metric: str, out_col: str = "share_pct", scale: int = 2) -> DataFrame:
    """metric * 100 / SUM(metric) per ``keys``, exact half-up at ``scale``; ``df`` is aggregated.

    The totals are a second, small aggregate (partial sums per task) joined back null-safe on the
    keys, so a key with very many groups is not gathered in one task."""
    keys = _cols(keys)
    totals = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.sum(metric).alias("_total"))
    cond = None
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(totals[f"_k{i}"])
        cond = c if cond is None else cond & c
    return df.join(totals, cond).withColumn(out_col, pct(F.col(metric), F.col("_total"), scale)).drop(
        "_total", *[f"_k{i}" for i in range(len(keys))])


def share_of_total(df: DataFrame, metric: str, out_col: str = "share_pct", share=pct) -> DataFrame:
    """metric * 100 / SUM(metric) over all rows, exact half-up at 2 dp; ``df`` is aggregated.

    The total is a one-row scalar subquery over the same aggregation (whose exchange is reused), so
    any number of groups stays spread over the tasks."""
    return (df.withColumn("_total", df.agg(F.sum(metric)).scalar())
              .withColumn(out_col, share(F.col(metric), F.col("_total"))).drop("_total"))


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """ORDER BY ... LIMIT n. Callers pass a complete tie-break so the rows kept are
    deterministic; Spark plans TakeOrderedAndProject (a per-task top-n, then a merge)."""
    return df.orderBy(*order).limit(n)


def labelled_counts(df: DataFrame, labels: dict[str, Column], label_col: str, value_col: str,
                    value_exprs: dict[str, Column] | None = None) -> DataFrame:
    """UNION ALL of one-row labelled aggregates, computed in a single scan.

    Each label gets ``count_if(predicate)`` (or the aggregate in ``value_exprs``); a label that
    matches no row still appears with 0 / NULL. ``stack`` turns the one wide row into rows.
    """
    aggs = []
    for i, (label, pred) in enumerate(labels.items()):
        agg = value_exprs[label] if value_exprs and label in value_exprs else F.count_if(pred)
        aggs.append(agg.alias(f"v{i}"))
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{label.replace(chr(39), chr(39) * 2)}', v{i}" for i, label in enumerate(labels))
    return wide.select(F.expr(f"stack({len(labels)}, {pairs}) as ({label_col}, {value_col})"))
