"""Named queries: one per operator of SURVEY section 2, each ``fn(spark, sf_dir) -> DataFrame``
over the driver tables, with its oracle SQL (DuckDB) where SQL can state the semantics."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from wardlens.functions.text import first_token, title_case
from wardlens.operators import clean as C
from wardlens.operators import entity as EN
from wardlens.operators import hierarchy as H
from wardlens.operators import load as L
from wardlens.operators import lookup as Y
from wardlens.operators import similarity as SI
from wardlens.operators.clean import clean_warehouse
from wardlens.operators.errorlog import ErrorLog
from wardlens.plans import oracle, storage
from wardlens.plans import reports as R
from wardlens.session import scratch_path
from wardlens.sources import standin
from wardlens.sources import tables as T
from wardlens.sources.delimited import read_delimited, write_delimited

Query = Callable[[SparkSession, str], DataFrame]


def clean_admissions(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = standin.ADMISSION_COLUMNS) -> DataFrame:
    """The warehouse clean table over the stand-in (or some of its columns): cased names, first-token
    hospital."""
    return clean_warehouse(standin.admissions(spark, sf_dir, columns))


# Reports as functions of the clean admissions table (the reference's reporting layer).
REPORTS_ON_CLEAN: dict[str, Callable[[DataFrame], DataFrame]] = {
    "average_stay": R.average_stay,
    "average_stay_truncated": lambda df: R.average_stay(df, mode="truncated"),
    "longest_stays": R.longest_stays,
    "monthly_report": lambda df: R.monthly_report(df, oracle.REPORT_YEAR),
    "monthly_admissions": R.monthly_admissions,
    "cases_by_gender": R.cases_by_gender,
    "top_conditions_by_gender": R.top_conditions_by_gender,
    "medication_by_condition": R.medication_by_condition,
    "hospital_condition_summary": R.hospital_condition_summary,
    "top_conditions_by_hospital": R.top_conditions_by_hospital,
    "cost_by_condition_hospital": R.cost_by_condition_hospital,
    "busiest_hospitals": R.busiest_hospitals,
    "condition_by_type": lambda df: R.condition_by_type(df, oracle.REPORT_HOSPITAL),
    "results_by_type": R.results_by_type,
    "cost_bands": R.cost_bands,
    "result_categories": R.result_categories,
    "gender_counts": R.gender_counts,
    "emergency_vs_elective": R.emergency_vs_elective,
    "billing_vs_daily_cost": R.billing_vs_daily_cost,
    "hospital_count": R.hospital_count,
    "billing_summary": R.billing_summary,
    "filtered_summary": lambda df: R.filtered_summary(df, oracle.REPORT_TYPE, oracle.REPORT_CONDITION),
    "value_distribution": lambda df: R.value_distribution(df, "admission_type"),
    "admissions_by_type": lambda df: R.admissions_by_type(df, oracle.REPORT_TYPE),
    "quietest_hospitals": lambda df: R.busiest_hospitals(df, ascending=True),
    "admission_peaks": R.admission_peaks,
    "row_count": lambda df: T.row_count(df),
    "profile_clean": lambda df: T.profile(df, distinct=False),
}


STAY = ("admission_date", "discharge_date")

# The columns of the clean table that a report reads, for those that do not read all: tables behind other
# columns are not joined.
REPORT_COLUMNS: dict[str, tuple[str, ...]] = {
    "average_stay": STAY,
    "average_stay_truncated": STAY,
    "longest_stays": ("name", "medical_condition", "hospital", *STAY),
    "monthly_report": ("admission_date", "billing_amount", "test_results"),
    "monthly_admissions": ("admission_date",),
    "cases_by_gender": ("gender", "medical_condition"),
    "top_conditions_by_gender": ("gender", "medical_condition"),
    "medication_by_condition": ("medical_condition", "medication", "gender"),
    "hospital_condition_summary": ("hospital", "medical_condition", "billing_amount", *STAY),
    "top_conditions_by_hospital": ("hospital", "medical_condition"),
    "cost_by_condition_hospital": ("hospital", "medical_condition", "billing_amount", *STAY),
    "busiest_hospitals": ("hospital",),
    "condition_by_type": ("hospital", "medical_condition", "admission_type"),
    "results_by_type": ("admission_type", "test_results"),
    "cost_bands": ("admission_type", "billing_amount"),
    "result_categories": ("test_results",),
    "gender_counts": ("gender",),
    "emergency_vs_elective": ("admission_type",),
    "billing_vs_daily_cost": ("billing_amount", *STAY),
    "hospital_count": ("hospital",),
    "billing_summary": ("medical_condition", "billing_amount"),
    "filtered_summary": ("hospital", "medical_condition", "admission_type", "billing_amount", *STAY),
    "value_distribution": ("admission_type",),
    "admissions_by_type": ("name", "medical_condition", "admission_type", "billing_amount", "admission_date"),
    "quietest_hospitals": ("hospital",),
    "admission_peaks": ("admission_date",),
    "row_count": ("gender",),
}


def _on_clean(name: str, report: Callable[[DataFrame], DataFrame]) -> Query:
    columns = REPORT_COLUMNS.get(name, standin.ADMISSION_COLUMNS)
    return lambda spark, sf_dir: report(clean_admissions(spark, sf_dir, columns))


REPORT_QUERIES: dict[str, Query] = {name: _on_clean(name, fn) for name, fn in REPORTS_ON_CLEAN.items()}


CLEANING_QUERIES: dict[str, Query] = {
    "clean_warehouse": clean_admissions,
    "first_token_entity": lambda spark, d: standin.admissions(spark, d, ("hospital",)).select(
        F.col("hospital").alias("raw_hospital"), first_token("hospital").alias("hospital")),
    "title_case_names": lambda spark, d: standin.admissions(spark, d, ("name",)).select(
        F.col("name").alias("raw_name"), title_case("name").alias("name")),
    "null_check": lambda spark, d: C.null_check(clean_admissions(spark, d, ("hospital", "name")), ("hospital", "name")),
    "raw_null_check": lambda spark, d: C.null_check(standin.admissions(spark, d, ("name", "admission_date")),
                                                    ("name", "admission_date")),
    "billing_preview": lambda spark, d: R.billing_preview(standin.billing_staging(spark, d), order=["staging_id"]),
    "delete_abnormal": lambda spark, d: T.row_count(T.delete_where(
        standin.admissions(spark, d, ("test_results",)), F.col("test_results").isin("Abnormal", "Inconclusive"))),
    "distinct_before_after": lambda spark, d: C.distinct_change(
        standin.admissions(spark, d, ("hospital",)), F.col("hospital"), first_token("hospital")),
    "conversion_issues": lambda spark, d: C.conversion_issues(standin.billing_staging(spark, d)),
    "conversion_diagnosis": lambda spark, d: C.conversion_issues(standin.billing_staging(spark, d),
                                                                 only_problems=False),
    "parse_dates": lambda spark, d: C.parse_dates(standin.billing_staging(spark, d)).select(
        "staging_id", "admission_date", "discharge_date"),
    "unparsed_dates": lambda spark, d: C.unparsed_dates(standin.billing_staging(spark, d)),
}

ENTITY_QUERIES: dict[str, Query] = {
    "anchor_entity": lambda spark, d: EN.anchor_entity(standin.admissions(spark, d, ("hospital",))).select(
        "hospital", "hospital_anchor"),
    "canonical_entity": lambda spark, d: EN.canonical_entity(standin.admissions(spark, d, ("hospital",))).select(
        "hospital", "hospital_anchor", "hospital_canonical"),
    "entity_audit": lambda spark, d: EN.entity_audit(standin.admissions(spark, d, ("hospital",))),
    "entity_audit_summary": lambda spark, d: EN.entity_audit_summary(standin.admissions(spark, d, ("hospital",))),
    "first_long_token_entity": lambda spark, d: EN.first_long_token_entity(
        standin.admissions(spark, d, ("hospital",))).select("hospital", "hospital_anchor"),
    "similar_entities": lambda spark, d: SI.similar_entities(standin.admissions(spark, d, ("hospital",)),
                                                             threshold=oracle.SIMILAR / 1000),
    "token_signature": lambda spark, d: EN.with_token_signature(standin.admissions(spark, d, ("hospital",))).select(
        "hospital", "hospital_clean"),
}


# The loading scenario over the stand-in: the open lines arrive as a batch for a table that
# already holds the finished lines; unique (patient_name, admission_date), billing 0..100000.
def load_rules() -> L.Constraints:
    return L.Constraints(unique=("patient_name", "admission_date"), not_null=("patient_name",),
                         checks=(L.Constraints.billing_range(0, 100000),))
LOAD_ORDER = ["order_key", "line_number"]
LOAD_COLUMNS = ["order_key", "line_number", "patient_name", "medical_condition", "billing_amount",
                "admission_date", "discharge_date"]


def load_batch_and_existing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = standin.admission_lines(spark, sf_dir).withColumnRenamed("name", "patient_name")
    batch = lines.filter(F.col("line_status") == "O").select(*LOAD_COLUMNS)
    existing = lines.filter(F.col("line_status") == "F").select(*LOAD_COLUMNS)
    return batch, existing


def _load(spark: SparkSession, sf_dir: str) -> L.LoadResult:
    batch, existing = load_batch_and_existing(spark, sf_dir)
    return L.load_constrained(batch, existing, load_rules(), LOAD_ORDER)


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir).rejected.drop("row_tag")


def _rejected_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 log rows by number and message: as many rows as rejections, each with its own id."""
    log = L.rejected_log_rows(_load(spark, sf_dir).rejected, "patient_name", "load")
    return log.groupBy("error_number", "error_message").agg(
        F.count(F.lit(1)).alias("log_rows"), F.count_distinct("error_id").alias("ids"),
        F.count_distinct("process_context").alias("contexts"))


def _strict_load_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows would stop a strict conversion, and how many an atomic insert."""
    typed = L.load_typed(standin.billing_staging(spark, sf_dir), key_col="staging_id").rejected
    atomic = _load(spark, sf_dir).rejected
    return (typed.agg(F.count(F.lit(1)).alias("failing_rows")).select(F.lit("conversion").alias("load"), "failing_rows")
            .union(atomic.agg(F.count(F.lit(1))).select(F.lit("constraints"), "*")))


def _violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, existing = load_batch_and_existing(spark, sf_dir)
    return L.violations(batch, existing, load_rules())


LOADING_QUERIES: dict[str, Query] = {
    "load_typed_accepted": lambda spark, d: L.load_typed(standin.billing_staging(spark, d), key_col="staging_id").accepted,
    "load_typed_rejected": lambda spark, d: L.load_typed(standin.billing_staging(spark, d), key_col="staging_id")
        .rejected.select("error_id", "error_number", "error_severity", "error_state", "error_message",
                         "process_context"),
    "cost_per_day": lambda spark, d: L.cost_per_day(
        clean_admissions(spark, d, ("name", "billing_amount", *STAY)).withColumnRenamed("name", "patient_name")),
    "diagnose_zero_stay": lambda spark, d: L.diagnose_zero_stay(
        clean_admissions(spark, d, ("name", "billing_amount", *STAY)).withColumnRenamed("name", "patient_name")),
    "insert_violations": _violations,
    "load_constrained_accepted": lambda spark, d: _load(spark, d).accepted,
    "load_constrained_rejected": _rejected,
    "load_constrained_log": _rejected_log,
    "strict_load_failures": _strict_load_failures,
}


REF_IDS = ("conv_id", "turn")
REF_PARENTS = ("conv_id", "parent_turn")


def _parent_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The referral key is (conv_id, turn): the parent id reported is the parent's turn.
    refs = standin.referrals(spark, sf_dir)
    return H.parent_links(refs, REF_IDS, REF_PARENTS).withColumn("parent_id", F.col("parent_id.`_p1`"))


def _runaway(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: a walk that needs more rounds than allowed fails; the error's number and the rows left to expand."""
    rows = []
    try:
        H.walk_hierarchy(standin.referrals(spark, sf_dir), REF_IDS, REF_PARENTS, max_recursion=oracle.RUNAWAY_ROUNDS)
    except H.RecursionLimitExceeded as e:
        rows.append((e.error_number, e.max_recursion, e.unfinished))
    return spark.createDataFrame(rows, "error_number int, max_recursion int, unfinished bigint")


HIERARCHY_QUERIES: dict[str, Query] = {
    "referral_chain": lambda spark, d: H.walk_hierarchy(standin.referrals(spark, d), REF_IDS, REF_PARENTS,
                                                        max_recursion=50).select(
        "conv_id", "turn", "patient_name", "depth", "from_department", "to_department", "referral_path")
        .orderBy("patient_name", "depth", "conv_id", "turn"),
    "referral_chain_guarded": lambda spark, d: H.walk_hierarchy(
        standin.referrals(spark, d), REF_IDS, REF_PARENTS, max_recursion=10,
        depth_guard=oracle.GUARD_DEPTH).select("patient_name", "depth", "to_department")
        .orderBy("patient_name", "depth", "to_department"),
    "referral_runaway": _runaway,
    "referral_roots": lambda spark, d: H.roots(standin.referrals(spark, d), ("parent_turn",)),
    "referral_parent_links": _parent_links,
}


def _lookup_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Y3 with Y1's cost: the finding for a number searched in the text column, and how many rows' text a
    mistyped comparison would have to convert."""
    staging = standin.billing_staging(spark, sf_dir)
    finding = Y.audit_lookup(spark, staging, "billing_amount", oracle.LOOKUP_VALUE, "staging")
    return finding.join(T.row_count(staging, "converted_rows"), F.lit(True)).select(
        "column_name", "column_type", "value_type", "converted_rows")


# Sinks: what is written to the shared scratch folder and read back equals what was written.
def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 then S1: the staging batch as a ';' file."""
    staging = standin.billing_staging(spark, sf_dir).withColumn("staging_id", F.col("staging_id").cast("string"))
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    write_delimited(staging, path)
    return read_delimited(spark, path, staging.schema).drop("_corrupt_record")


def _materialised_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 then Q21: the clean table written by admission type, its distribution read from the written table."""
    clean = clean_admissions(spark, sf_dir)
    table = T.materialise(clean, scratch_path(spark, f"clean-{uuid.uuid4().hex}"), ["admission_type"])
    return R.value_distribution(table, "admission_type")


def _append_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two renamed projections of the admissions appended to one table."""
    raw = standin.admissions(spark, sf_dir, ("gender", "billing_amount", "test_results"))
    path = scratch_path(spark, f"append-{uuid.uuid4().hex}")
    for source in ("gender", "test_results"):
        T.append_to(raw, path, {source: "label", "billing_amount": "amount"})
    return spark.read.schema("label string, amount decimal(18,2)").parquet(path).groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"))


def _log_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load's rejections logged by two tries of one run, a finding beside them, then searched."""
    log = ErrorLog(spark, scratch_path(spark, f"log-{uuid.uuid4().hex}"))
    rows = L.rejected_log_rows(_load(spark, sf_dir).rejected, "patient_name", "load")
    for _ in range(2):
        log.append(rows, "load")
    log.finding("Stand-in batch checked", "Scenario 6 — investigation")
    return log.search("Scenario 5%", ["error_number", "error_message", "process_context"])


SINK_QUERIES: dict[str, Query] = {
    "csv_round_trip": _csv_round_trip,
    "materialised_distribution": _materialised_distribution,
    "append_mapped": _append_mapped,
    "error_log_search": _log_search,
}


LOOKUP_QUERIES: dict[str, Query] = {
    "lookup_audit": _lookup_audit,
    "typed_lookup": lambda spark, d: Y.typed_lookup(standin.billing_staging(spark, d), "billing_amount",
                                                    oracle.LOOKUP_VALUE),
}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for group in (REPORT_QUERIES, CLEANING_QUERIES, ENTITY_QUERIES, LOADING_QUERIES, HIERARCHY_QUERIES, SINK_QUERIES,
                  LOOKUP_QUERIES, storage.QUERIES):
        out.update(group)
    return out


def all_oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    for group in (oracle.REPORTS, oracle.CLEANING, oracle.ENTITY, oracle.LOADING, oracle.HIERARCHY, oracle.SINKS,
                  oracle.LOOKUP, storage.ORACLES):
        out.update(group)
    return out
