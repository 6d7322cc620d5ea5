"""Defensive loading: safe conversion and constraint rules evaluated for every
row in one pass; bad rows are routed to the error log instead of failing the job.

The reference walks the batch with a cursor and a TRY/CATCH per row. Here every rule is a
column expression; the batch is labelled once, then split into accepted and rejected rows.
``run_*`` helpers materialise the labelled batch once (a reliable checkpoint in the shared
folder) before writing both outputs, so a non-deterministic input cannot land in both. A run's rows
in the target and in the log are commits (``sources.committed``): a repeated run replaces both, and its own earlier
rows never count as existing.
"""

from __future__ import annotations

import weakref
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.dates import parse_date, stay_days
from wardlens.functions.numeric import MONEY, money_per_day, safe_number, strict_number
from wardlens.operators.errorlog import ErrorLog, log_rows
from wardlens.session import cut_lineage
from wardlens.sources.committed import Committed


@dataclass
class LoadResult:
    accepted: DataFrame
    rejected: DataFrame


# ---------------------------------------------------------------------------------------------
# L2/L3: conversion load

# The conversion failure as the reference's log records it.
CONVERSION_ERROR_NUMBER = 8114
CONVERSION_MESSAGE = "Error converting data type nvarchar to numeric."
CONVERSION_CONTEXT = "Scenario 1 — Billing_Amount conversion failure: "


def load_typed(staging: DataFrame, conversions: dict[str, str] | None = None, *, key_col: str,
               name_col: str = "name", on_error: str = "route", run_id: str = "load",
               context_prefix: str = CONVERSION_CONTEXT) -> LoadResult:
    """L3 (``route``): convert text columns (numeric types, or ``"date"`` with the accepted date
    layouts); rows where a non-NULL value fails go to ``rejected`` as error-log rows, the rest to
    ``accepted`` with typed values. NULL stays NULL and is accepted. ``key_col`` is the source
    row's key: two rejected rows have different log ids if their keys differ.
    L2 (``fail``): the accepted frame uses strict casts, so the first bad value fails the job."""
    conversions = conversions or {"billing_amount": MONEY}
    if on_error == "fail":
        typed = staging
        for col, dtype in conversions.items():
            strict = (F.when(F.col(col).isNotNull() & parse_date(col).isNull(),
                             F.raise_error(F.concat(F.lit("Conversion failed when converting date: "), F.col(col))))
                       .otherwise(parse_date(col)) if dtype == "date" else strict_number(col, dtype))
            typed = typed.withColumn(col, strict)
        nothing = log_rows(staging.limit(0), run_id=run_id, key=F.lit(None), number=CONVERSION_ERROR_NUMBER,
                           message=CONVERSION_MESSAGE, context=CONVERSION_CONTEXT)
        return LoadResult(typed, nothing)
    if on_error != "route":
        raise ValueError(f"unknown on_error {on_error!r}")
    convert = {c: (parse_date(c) if t == "date" else safe_number(c, t)) for c, t in conversions.items()}
    failed = [F.when(F.col(c).isNotNull() & conv.isNull(), F.lit(c)) for c, conv in convert.items()]
    labelled = staging.withColumn("_failed", F.array_compact(F.array(*failed)))
    ok = labelled.filter(F.size("_failed") == 0).drop("_failed")
    for col, conv in convert.items():
        ok = ok.withColumn(col, conv)
    bad = labelled.filter(F.size("_failed") > 0)
    rejected = log_rows(bad, run_id=run_id, key=F.col(key_col), number=CONVERSION_ERROR_NUMBER, message=CONVERSION_MESSAGE,
                        context=F.concat(F.lit(context_prefix), F.col(name_col)))
    return LoadResult(ok, rejected)


# ---------------------------------------------------------------------------------------------
# L4: zero denominators

# The two flag wordings of the reference.
FLAG_REVIEW = "Flagged — same day discharge, review source data"
FLAG_SHORT = "Flagged — same day discharge"


def cost_per_day(df: DataFrame, name_col: str = "patient_name", wording: str = "review") -> DataFrame:
    """L4: stay days, cost per day (NULL on a zero stay, 2 dp half-up) and a quality flag."""
    s = stay_days("admission_date", "discharge_date")
    flag = FLAG_REVIEW if wording == "review" else FLAG_SHORT
    return df.select(
        F.col(name_col), "billing_amount", s.alias("stay_days"),
        money_per_day("billing_amount", s).alias("cost_per_day"),
        F.when(s == 0, flag).otherwise("Valid").alias("data_quality_flag"))


def diagnose_zero_stay(df: DataFrame, name_col: str = "patient_name") -> DataFrame:
    """L4 diagnosis: which rows would divide by zero."""
    s = stay_days("admission_date", "discharge_date")
    return df.select(F.col(name_col), "billing_amount", s.alias("stay_days"),
                     F.when(s == 0, "ZERO STAY — will cause divide-by-zero").otherwise("Valid").alias("diagnosis"))


# ---------------------------------------------------------------------------------------------
# Constraint-checked insert

@dataclass
class Constraints:
    """Table rules: NOT NULL columns, CHECK predicates (NULL passes), one UNIQUE key (NULLs equal)."""

    unique: tuple[str, ...] = ("patient_name", "admission_date")
    not_null: tuple[str, ...] = ("patient_name",)
    checks: tuple[tuple[str, Column], ...] = ()

    @staticmethod
    def billing_range(lo: float = 0, hi: float = 150000, col: str = "billing_amount") -> tuple[str, Column]:
        return (f"CHECK violation: {col} between {lo:g} and {hi:g}", F.col(col).between(F.lit(lo), F.lit(hi)))


# Error numbers a SQL engine reports for these violations (NULL into a NOT NULL
# column, CHECK constraint, UNIQUE constraint).
NOT_NULL_ERROR_NUMBER = 515
CHECK_ERROR_NUMBER = 547
UNIQUE_ERROR_NUMBER = 2627

# The labels of the pre-insert violation report.
VIOLATION_DUPLICATE = "DUPLICATE — violates UQ_patient_admission"
VIOLATION_RANGE = "BILLING OUT OF RANGE — violates CHK_billing_range"

# Reasons of a routed load; the context is the reference's (fixed value).
DUPLICATE_EXISTING = "DUPLICATE — violates unique key (existing row)"
DUPLICATE_BATCH = "DUPLICATE — violates unique key (earlier row in batch)"
CONSTRAINT_CONTEXT = "Scenario 5 — constraint violation: "


def _check_violation(rules: Constraints) -> Column:
    """First violated NOT NULL / CHECK rule, or NULL."""
    branches = [(F.col(c).isNull(), f"NOT NULL violation: {c}") for c in rules.not_null]
    branches += [(~F.coalesce(pred, F.lit(True)), label) for label, pred in rules.checks]
    out = None
    for cond, label in branches:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out if out is not None else F.lit(None).cast("string")


def _keys_hit(existing: DataFrame, wanted: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    """The distinct keys of ``existing`` (as _x0, _x1, ...) that ``wanted`` (as _w0, _w1, ...) asks for. A
    semi-join, so a batch small enough to broadcast leaves the existing table unshuffled, and the
    distinct sees only the keys that can collide."""
    rows = existing.select(*[F.col(k).alias(f"_x{i}") for i, k in enumerate(keys)])
    cond = None
    for i in range(len(keys)):
        c = rows[f"_x{i}"].eqNullSafe(wanted[f"_w{i}"]) if null_safe else rows[f"_x{i}"] == wanted[f"_w{i}"]
        cond = c if cond is None else cond & c
    return rows.join(wanted, cond, "left_semi").distinct().withColumn("_exists", F.lit(True))


def violations(batch: DataFrame, existing: DataFrame, rules: Constraints,
               labels: dict[str, str] | None = None) -> DataFrame:
    """Pre-insert report, key columns + violation_type. Duplicates against *existing* rows
    UNION ALL failed CHECK rules; a row breaking both appears twice; duplicates inside the batch
    are not listed; keys match by plain equality, so a NULL key part never does. One pass over the
    batch: a left join with the distinct colliding keys flags duplicates, then an array of violated
    rules is exploded. ``labels`` renames a CHECK rule (default: the billing range's label)."""
    keys = list(rules.unique)
    wanted = batch.select(*[F.col(k).alias(f"_w{i}") for i, k in enumerate(keys)])
    hit = _keys_hit(existing, wanted, keys, null_safe=False)
    cond = None
    for i, k in enumerate(keys):
        c = batch[k] == hit[f"_x{i}"]
        cond = c if cond is None else cond & c
    flagged = batch.join(hit, cond, "left")
    found = [F.when(F.col("_exists"), F.lit(VIOLATION_DUPLICATE))]
    found += [F.when(~F.coalesce(pred, F.lit(True)), F.lit((labels or {}).get(label, VIOLATION_RANGE)))
              for label, pred in rules.checks]
    return flagged.select(*[batch[k] for k in keys], F.explode(F.array_compact(F.array(*found))).alias("violation_type"))


_WRITTEN: weakref.WeakSet = weakref.WeakSet()  # frames that ``written`` made


def written(df: DataFrame) -> DataFrame:
    """A reliable checkpoint that ``label_batch`` does not write again."""
    out = cut_lineage(df)
    _WRITTEN.add(out)
    return out


def label_batch(batch: DataFrame, existing: DataFrame, rules: Constraints, order_cols: list[str]) -> DataFrame:
    """Every batch row with ``row_tag`` (unique in the batch) and ``reason`` (NULL when it is accepted).

    Rows arrive in ``order_cols`` order (ties broken by the remaining columns, then by the tag).
    Semantics of a row-by-row insert: NOT NULL and CHECK first (a rejected row does not reserve
    its key); then UNIQUE over the existing rows and the earlier accepted rows of the batch, NULL
    keys equal.

    Scale: the batch is written once (a reliable checkpoint: tags of written rows do not change
    when a task is retried), unless the caller has ``written`` it. The first row per key is a ``min(struct(order..., tag))`` aggregate
    with map-side combine (no per-key sort, a hot key is one row per task), joined back on the
    key (AQE splits a hot key's rows). Existing rows enter through a semi-join on the batch's keys."""
    cols = batch.columns
    keys = list(rules.unique)
    rest = [c for c in cols if c not in order_cols]
    d = (batch if batch in _WRITTEN else cut_lineage(batch)).withColumn("_check", _check_violation(rules))
    d = d.withColumn("row_tag", F.monotonically_increasing_id())
    d = d.withColumn("_order", F.struct(*[F.col(c) for c in [*order_cols, *rest, "row_tag"]]))
    first = (d.filter(F.col("_check").isNull()).groupBy(*[F.col(k).alias(f"_w{i}") for i, k in enumerate(keys)])
             .agg(F.min("_order").alias("_first")))
    hit = _keys_hit(existing, first, keys, null_safe=True)
    cond = None
    for i in range(len(keys)):
        c = first[f"_w{i}"].eqNullSafe(hit[f"_x{i}"])
        cond = c if cond is None else cond & c
    first = first.join(hit, cond, "left").select(
        *[f"_w{i}" for i in range(len(keys))], F.col("_first.row_tag").alias("_first_tag"),
        F.coalesce("_exists", F.lit(False)).alias("_exists"))
    cond = None
    for i, k in enumerate(keys):
        c = d[k].eqNullSafe(first[f"_w{i}"])
        cond = c if cond is None else cond & c
    reason = (F.when(F.col("_check").isNotNull(), F.col("_check"))
               .when(F.col("_exists"), F.lit(DUPLICATE_EXISTING))
               .when(F.col("row_tag") != F.col("_first_tag"), F.lit(DUPLICATE_BATCH)))
    return d.join(first, cond, "left").select(*[d[c] for c in cols], "row_tag", reason.alias("reason"))


def split_labelled(labelled: DataFrame, cols: list[str]) -> LoadResult:
    return LoadResult(labelled.filter(F.col("reason").isNull()).select(*cols),
                      labelled.filter(F.col("reason").isNotNull()).select(*cols, "reason", "row_tag"))


def load_constrained(batch: DataFrame, existing: DataFrame, rules: Constraints, order_cols: list[str],
                     on_error: str = "route") -> LoadResult:
    """L6 (``route``): accepted rows and rejected rows (with reason and row tag), one per input row.
    L7 (``atomic``): raise when any row would be rejected, before anything is written."""
    result = split_labelled(label_batch(batch, existing, rules, order_cols), batch.columns)
    if on_error == "atomic":
        n = result.rejected.count()
        if n:
            raise ValueError(f"batch rejected: {n} row(s) violate constraints; nothing inserted")
    elif on_error != "route":
        raise ValueError(f"unknown on_error {on_error!r}")
    return result


def rejected_log_rows(rejected: DataFrame, name_col: str, run_id: str) -> DataFrame:
    """Error-log rows for constraint rejections: one per rejected row, each with its own id."""
    ctx = F.concat(F.lit(CONSTRAINT_CONTEXT), F.coalesce(F.col(name_col).cast("string"), F.lit("NULL")))
    key = F.to_json(F.struct(*[F.col(c) for c in rejected.columns if c != "reason"]))
    reason = F.col("reason")
    number = (F.when(reason.startswith("NOT NULL"), F.lit(NOT_NULL_ERROR_NUMBER))
               .when(reason.startswith("CHECK"), F.lit(CHECK_ERROR_NUMBER))
               .otherwise(F.lit(UNIQUE_ERROR_NUMBER)))
    return log_rows(rejected, run_id=run_id, key=key, number=number, message=reason, context=ctx, state=1)


def run_constrained_load(batch: DataFrame, rules: Constraints, order_cols: list[str], target_path: str,
                         log: ErrorLog, name_col: str = "patient_name", run_id: str = "load", part: str = "run_id",
                         partition_col: str | None = None) -> dict:
    """Label the batch once against the keys that other runs have loaded into ``target_path`` (their key index,
    only the buckets that the batch's keys fall into; not the table), commit the accepted rows with their
    keys as run ``run_id`` and log every rejected row. A rerun of the same ``run_id`` gives the same target and the
    same number of log rows."""
    target, keys = Committed(batch.sparkSession, target_path, part), list(rules.unique)
    batch = written(batch)
    existing = target.existing_keys(batch.schema, keys, batch, without=run_id)
    labelled = cut_lineage(label_batch(batch, existing, rules, order_cols))
    res = split_labelled(labelled, batch.columns)
    target.replace_run(res.accepted, run_id, partition_col, keys)
    log.append(rejected_log_rows(res.rejected, name_col, run_id), run_id)
    counts = labelled.agg(F.count(F.lit(1)).alias("rows"), F.count("reason").alias("rejected")).first()
    return {"rows": counts["rows"], "accepted": counts["rows"] - counts["rejected"], "rejected": counts["rejected"]}


def run_typed_load(staging: DataFrame, target_path: str, log: ErrorLog, conversions: dict[str, str] | None = None,
                   *, key_col: str, name_col: str = "name", run_id: str = "load", part: str = "run_id") -> dict:
    """Convert once (checkpointed), commit the accepted rows as run ``run_id`` and log the failed
    conversions; a rerun replaces both. The counts come from the written rows."""
    target = Committed(staging.sparkSession, target_path, part)
    res = load_typed(cut_lineage(staging), conversions, name_col=name_col, key_col=key_col, run_id=run_id)
    target.replace_run(res.accepted, run_id)
    log.append(res.rejected, run_id)
    accepted = target.read(res.accepted.schema, only=run_id).count()
    rejected = log.read(run_id).count()
    return {"rows": accepted + rejected, "accepted": accepted, "rejected": rejected}
