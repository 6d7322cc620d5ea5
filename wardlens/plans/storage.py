"""Named queries over what the library writes: committed tables, loads in several runs, streams, layouts, logs and numbers, each
with the DuckDB SQL that its re-read result must equal. Written tables live in the shared scratch folder of the session."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens import session as S
from wardlens.functions.dates import days_before
from wardlens.functions.numeric import is_numeric_text
from wardlens.operators import entity as EN
from wardlens.operators import hierarchy as H
from wardlens.operators import layout as LY
from wardlens.operators import load as L
from wardlens.operators import lookup as Y
from wardlens.operators import numbering as N
from wardlens.operators.errorlog import ErrorLog, JobFailed, log_rows, logged_job
from wardlens.plans import oracle as O
from wardlens.plans import reports as R
from wardlens.schema import ADMISSIONS_FILE
from wardlens.sources import standin
from wardlens.sources import tables as T
from wardlens.sources.committed import Committed
from wardlens.sources.delimited import read_delimited, write_delimited
from wardlens.streaming.loader import stream_typed_load

Query = Callable[[SparkSession, str], DataFrame]


def _scratch(spark: SparkSession, name: str) -> str:
    return S.scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------------------------------------
# committed tables

DELETE_COLUMNS = ("gender", "admission_type", "test_results", "billing_amount")


def _deleted() -> F.Column:
    return (F.col("admission_type") == "Urgent") & F.col("test_results").isin("Abnormal", "Inconclusive")


def delete_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The admissions of two runs in one committed table; one type's abnormal results are deleted, which writes only the
    files of that type again; the table read back."""
    rows = standin.admissions(spark, sf_dir, DELETE_COLUMNS)
    table = Committed(spark, _scratch(spark, "delete"))
    for gender in ("Male", "Female"):
        table.replace_run(rows.filter(F.col("gender") == gender), gender, "admission_type")
    table.delete(rows.schema, _deleted(), "admission_type")
    return table.read(rows.schema)


LOAD_RULES = dict(unique=("patient_name", "admission_date"), not_null=("patient_name",))
LOAD_COLUMNS = ["order_key", "line_number", "patient_name", "medical_condition", "billing_amount", "admission_date",
                "discharge_date"]


def load_committed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The finished lines loaded as one run, then the open lines as another, which meets the first one's keys
    through the key index; the second run is loaded twice, as after a lost driver. The table read back with its runs."""
    lines = standin.admission_lines(spark, sf_dir).withColumnRenamed("name", "patient_name").select("line_status", *LOAD_COLUMNS)
    rules = L.Constraints(checks=(L.Constraints.billing_range(0, 100000),), **LOAD_RULES)
    staged = _scratch(spark, "load-lines")  # joined once
    lines.write.parquet(staged)
    lines = spark.read.schema(lines.schema).parquet(staged)
    path, log = _scratch(spark, "load"), ErrorLog(spark, _scratch(spark, "load-log"))
    for status, run in (("F", "finished"), ("O", "open"), ("O", "open")):
        L.run_constrained_load(lines.filter(F.col("line_status") == status).select(*LOAD_COLUMNS), rules,
                               ["order_key", "line_number"], path, log, run_id=run)
    schema = lines.select(*LOAD_COLUMNS).schema.add("run_id", "string")
    return Committed(spark, path).read(schema)


def stream_load_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nightly load as a stream: the staged events arrive in several epochs; the last one is replayed, as
    after a driver lost before its commit. The accepted rows and the log read back: a replay changes neither."""
    staging = standin.billing_staging(spark, sf_dir)
    source, target, log, ckpt = (_scratch(spark, f"stream-{n}") for n in ("source", "target", "log", "ckpt"))
    staging.write.partitionBy("medical_condition").parquet(source)
    files = len(spark.read.parquet(source).inputFiles())

    def run() -> None:
        stream = spark.readStream.schema(staging.schema).option("maxFilesPerTrigger", -(-files // 3)).parquet(source)
        stream_typed_load(spark, stream, target, log, ckpt, key_col="staging_id").awaitTermination()

    run()
    commits = sorted((n for n in S.list_names(spark, f"{ckpt}/commits") if n.isdigit()), key=int)
    S.delete_folder(spark, f"{ckpt}/commits/{commits[-1]}")
    run()
    schema = staging.schema
    accepted = Committed(spark, target, "epoch").read(staging.withColumn("billing_amount", F.lit(None).cast("decimal(18,2)")).schema)
    rejected = ErrorLog(spark, log).read()
    return (accepted.select(F.lit("accepted").alias("outcome"), *schema.fieldNames()).unionByName(
        rejected.select(F.lit("rejected").alias("outcome"), F.col("process_context").alias("name")), allowMissingColumns=True))


# ---------------------------------------------------------------------------------------------
# logs

def strict_and_atomic_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strict conversion and an atomic insert, both run as logged jobs that must fail: what the log holds, what
    is raised, and how many rows were written."""
    log, out = ErrorLog(spark, _scratch(spark, "strict-log")), []
    lines = standin.admission_lines(spark, sf_dir).withColumnRenamed("name", "patient_name")
    rules = L.Constraints(checks=(L.Constraints.billing_range(0, 100000),), **LOAD_RULES)
    batch, existing = (lines.filter(F.col("line_status") == s).select(*LOAD_COLUMNS) for s in "OF")
    loads = {
        "conversion": lambda: L.load_typed(standin.billing_staging(spark, sf_dir), key_col="staging_id", on_error="fail").accepted,
        "constraints": lambda: L.load_constrained(batch, existing, rules, ["order_key", "line_number"], on_error="atomic").accepted,
    }
    for name, load in loads.items():
        table, raised = Committed(spark, _scratch(spark, f"strict-{name}")), None
        try:
            with logged_job(log, name, f"Scenario 1 — {name}"):
                rows = load()
                table.replace_run(rows, "load")
        except JobFailed as e:
            raised = e.number
        out.append((name, raised, len(table.files())))
    ran = spark.createDataFrame(out, "load string, raised int, files_written int")
    logged = log.read().select(F.col("error_procedure").alias("load"), "error_number",
                               F.regexp_extract("error_message", r"batch rejected: (\d+) row", 1).alias("rejected_rows"))
    return ran.join(logged, "load", "left")


def error_log_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversion errors logged with the time of their admission, then a finding, whose time is that of its
    writing: the whole log, newest first."""
    log = ErrorLog(spark, _scratch(spark, "log"))
    rejected = standin.billing_staging(spark, sf_dir).filter(~is_numeric_text("billing_amount"))
    rows = log_rows(rejected, run_id="dated", key=F.col("staging_id"), number=L.CONVERSION_ERROR_NUMBER, message=L.CONVERSION_MESSAGE,
                    context=F.concat(F.lit("Scenario 1 — "), F.col("name")), at=F.to_timestamp("admission_date"))
    log.append(rows, "dated")
    log.finding("Stand-in batch checked", "Scenario 6 — investigation")
    manual = F.col("process_context").like("Scenario 6%")
    return log.search().select("error_number", "error_message", "process_context",
                               F.when(~manual, F.col("error_datetime").cast("date")).alias("error_date"), manual.alias("is_finding"))


# ---------------------------------------------------------------------------------------------
# layouts and lookups

POINT_ID = 4242


def point_lookup_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging batch clustered for lookups by id and by amount, then looked up by either."""
    path = _scratch(spark, "lookup")
    LY.write_point_lookup_layout(standin.billing_staging(spark, sf_dir), path, "staging_id", "billing_amount", files=16)
    table = spark.read.parquet(path)
    return (Y.typed_lookup(table, "billing_amount", O.LOOKUP_VALUE).withColumn("looked_up", F.lit("billing_amount"))
            .unionByName(Y.typed_lookup(table, "staging_id", str(POINT_ID)).withColumn("looked_up", F.lit("staging_id"))))


def naive_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mistyped lookup: every row's text is converted and compared as a number."""
    staging = standin.billing_staging(spark, sf_dir).filter(is_numeric_text("billing_amount"))
    return Y.naive_lookup(staging, "billing_amount", O.LOOKUP_VALUE)


PIECES, PIECE_ROWS = 12, 1_000_000


def _small_pieces(rows: int) -> int:
    """Pieces that a table of so many rows is written in: a task sorts ``PIECE_ROWS`` at most, whatever the table's size."""
    return max(PIECES, -(-rows // PIECE_ROWS))


def layout_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The admissions written in many small files by type, their health taken, the folders marked for it rebuilt, and
    read back."""
    rows = standin.admissions(spark, sf_dir, ("admission_type", "gender", "billing_amount"))
    table = Committed(spark, _scratch(spark, "rebuild"))
    table.replace_run(rows.repartition(_small_pieces(T.read_table(spark, sf_dir, "lineitem").count())), "admissions", "admission_type")
    LY.rebuild(table, rows.schema, ["gender"], "admission_type")
    return table.read(rows.schema)


def comma_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The admissions as a comma file of the declared layout (day-first dates), read back by that schema."""
    rows = standin.admissions(spark, sf_dir)
    day = {c: F.date_format(c, "dd/MM/yyyy") for c in ("admission_date", "discharge_date")}
    path = _scratch(spark, "comma")
    write_delimited(rows.select(*[day.get(f.name, F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                                  for f in ADMISSIONS_FILE.fields]), path, sep=",")
    return read_delimited(spark, path, ADMISSIONS_FILE, sep=",").drop("_corrupt_record")


def profile_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S16 with exact distinct counts, of the raw admissions."""
    return T.profile(standin.admissions(spark, sf_dir, ("gender", "admission_date", "admission_type", "billing_amount", "test_results")),
                     distinct="exact")


# ---------------------------------------------------------------------------------------------
# numbers, order, walks, dates

def group_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hospital anchor with its number in order of first appearance among the lines."""
    lines = standin.admission_lines(spark, sf_dir).select("order_key", "line_number", "hospital")
    return N.first_appearance(EN.anchor_entity(lines), "hospital_anchor", ["order_key", "line_number"])


def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging batch numbered by its id."""
    return N.number_rows(standin.billing_staging(spark, sf_dir).select("staging_id", "name"), ["staging_id"], "row_number")


def admissions_by_type_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1, Q22 with equal rows spread over the pieces of the order."""
    columns = ("name", "medical_condition", "admission_type", "billing_amount", "admission_date")
    return R.admissions_by_type(standin.admissions(spark, sf_dir, columns), O.REPORT_TYPE, spread_copies=True)


REF_IDS, REF_PARENTS = ("conv_id", "turn"), ("conv_id", "parent_turn")


def referral_chain_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1, J3, U3 by pointer doubling."""
    return H.walk_by_doubling(standin.referrals(spark, sf_dir), REF_IDS, REF_PARENTS, max_recursion=50).select(
        "conv_id", "turn", "patient_name", "depth", "from_department", "to_department", "referral_path")


def referral_guarded_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2 by pointer doubling."""
    return H.walk_by_doubling(standin.referrals(spark, sf_dir), REF_IDS, REF_PARENTS, max_recursion=10,
                              depth_guard=O.GUARD_DEPTH).select("patient_name", "depth", "to_department")


RECENT_AS_OF, RECENT_DAYS = "1998-01-01", 365


def recent_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """admissions of the year before a date, by type."""
    rows = standin.admissions(spark, sf_dir, ("admission_type", "admission_date"))
    lo = days_before(RECENT_AS_OF, RECENT_DAYS)
    return (rows.filter((F.col("admission_date") >= lo) & (F.col("admission_date") <= F.lit(RECENT_AS_OF).cast("date")))
            .groupBy("admission_type").agg(F.count(F.lit(1)).alias("admissions")))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    delete_rewrite, load_committed_runs, stream_load_replayed, strict_and_atomic_loads, error_log_newest_first, point_lookup_layout,
    naive_lookup, layout_rebuilt, comma_file, profile_distinct, group_numbers, row_numbers, admissions_by_type_spread,
    referral_chain_doubling, referral_guarded_doubling, recent_admissions)}


_COLS = O.LOAD_BATCH_COLS
_KEPT = ("SELECT *, row_number() OVER (PARTITION BY patient_name, admission_date ORDER BY "
         + ", ".join(f"{c} NULLS FIRST" for c in LOAD_COLUMNS) + ") AS rn FROM (SELECT *, name AS patient_name FROM lines) WHERE name IS NOT NULL AND coalesce(billing_amount BETWEEN 0 AND 100000, true)")
_RUNS = (f"WITH lines AS ({O.ADMISSION_LINES}), f AS (SELECT * FROM ({_KEPT} AND line_status = 'F') WHERE rn = 1), "
         f"o AS ({_KEPT} AND line_status = 'O') "
         f"SELECT {_COLS}, 'finished' AS run_id FROM f UNION ALL SELECT {_COLS}, 'open' FROM o WHERE rn = 1 AND NOT EXISTS "
         f"(SELECT 1 FROM f WHERE f.patient_name = o.patient_name AND f.admission_date IS NOT DISTINCT FROM o.admission_date)")
_PROFILED = {"gender": "string", "admission_date": "date", "admission_type": "string", "billing_amount": "decimal(18,2)", "test_results": "string"}

ORACLES: dict[str, str] = {
    "delete_rewrite": O.with_raw(f"SELECT {', '.join(DELETE_COLUMNS)} FROM admissions WHERE NOT coalesce(admission_type = 'Urgent' "
                                 "AND test_results IN ('Abnormal', 'Inconclusive'), false)"),
    "load_committed_runs": _RUNS,
    "stream_load_replayed": O.with_staging(
        f"SELECT 'accepted' AS outcome, staging_id, name, medical_condition, {O.safe_number_sql('billing_amount')} AS billing_amount, "
        f"admission_date, discharge_date FROM staging WHERE {O._CONV_OK} UNION ALL "
        f"SELECT 'rejected', NULL, {O._CONV_CTX}, NULL, NULL, NULL, NULL FROM staging WHERE NOT {O._CONV_OK}"),
    "strict_and_atomic_loads": O._LOAD_CTES + (
        f"SELECT DISTINCT 'conversion' AS load, 50001 AS raised, 0 AS files_written, 8114 AS error_number, '' AS rejected_rows "
        f"FROM ({O.STAGING}) WHERE NOT {O._CONV_OK} "
        f"UNION ALL SELECT 'constraints', 50001, 0, 50000, CAST(count(*) AS VARCHAR) FROM ({O._REJECTED})"),
    "error_log_newest_first": O.with_staging(
        f"SELECT error_number, error_message, process_context, error_date, is_finding FROM (SELECT 8114 AS error_number, "
        f"'Error converting data type nvarchar to numeric.' AS error_message, 'Scenario 1 — ' || name AS process_context, "
        f"CAST(admission_date AS DATE) AS error_date, false AS is_finding, "
        + O.error_id_sql("dated", "staging_id", "'Scenario 1 — ' || name") +
        f" AS id FROM staging WHERE NOT {O._CONV_OK} UNION ALL "
        f"SELECT 0, 'Stand-in batch checked', 'Scenario 6 — investigation', NULL, true, '') ORDER BY error_date DESC NULLS FIRST, id"),
    "point_lookup_layout": O.with_staging(
        f"SELECT *, 'billing_amount' AS looked_up FROM staging WHERE billing_amount = '{O.LOOKUP_VALUE!r}' "
        f"UNION ALL SELECT *, 'staging_id' FROM staging WHERE staging_id = {POINT_ID}"),
    "naive_lookup": O.with_staging(f"SELECT * FROM staging WHERE TRY_CAST(billing_amount AS DOUBLE) = CAST({O.LOOKUP_VALUE!r} AS DOUBLE)"),
    "layout_rebuilt": O.with_raw("SELECT admission_type, gender, billing_amount FROM admissions"),
    "comma_file": O.with_raw("SELECT " + ", ".join(
        f"strftime({f.name}, '%d/%m/%Y') AS {f.name}" if f.name.endswith("_date") else f.name
        if f.name in standin.ADMISSION_COLUMNS else f"NULL AS {f.name}" for f in ADMISSIONS_FILE.fields) + " FROM admissions"),
    "profile_distinct": O.with_raw(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, count(*) - count({c}) AS null_count, "
        f"count(DISTINCT {c}) AS distinct_values FROM admissions" for c, t in _PROFILED.items())),
    "group_numbers": (f"{O._ENTITY_CTES}, lines AS ({O.ADMISSION_LINES}), firsts AS (SELECT m.anchor, min((order_key, line_number)) AS p "
                      f"FROM lines l JOIN mapping m ON rtrim(l.hospital, ',') = m.hospital GROUP BY 1) "
                      f"SELECT anchor AS hospital_anchor, dense_rank() OVER (ORDER BY p) - 1 AS group_number FROM firsts"),
    "row_numbers": O.with_staging("SELECT staging_id, name, row_number() OVER (ORDER BY staging_id) AS row_number FROM staging"),
    "admissions_by_type_spread": O.with_raw(
        f"SELECT name AS patient_name, medical_condition, admission_type, billing_amount, admission_date FROM admissions "
        f"WHERE admission_type = '{O.REPORT_TYPE}' ORDER BY admission_date DESC NULLS LAST, patient_name NULLS LAST, "
        f"medical_condition NULLS LAST, billing_amount NULLS LAST"),
    "referral_chain_doubling": O.HIERARCHY["referral_chain"],
    "referral_guarded_doubling": O.HIERARCHY["referral_chain_guarded"],
    "recent_admissions": O.with_raw(f"SELECT admission_type, count(*) AS admissions FROM admissions WHERE admission_date >= "
                                    f"DATE '{RECENT_AS_OF}' - {RECENT_DAYS} AND admission_date <= DATE '{RECENT_AS_OF}' GROUP BY 1"),
}
