"""The central error log: a parquet table with one folder per run.

A run (a batch load, a streaming epoch) commits its rows as its own (``sources.committed``), so a repeated run
replaces its rows instead of doubling them; rows of other runs are never touched. ``error_id`` is
a hash of the run, the source row's key and the context: unique for a unique key.
"""

from __future__ import annotations

import contextlib
import re
import uuid
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.schema import ERROR_LOG
from wardlens.sources.committed import Committed

# Error numbers the reference's log carries for these failures.
ERROR_NUMBERS = {"CAST_INVALID_INPUT": 8114, "DIVIDE_BY_ZERO": 8134, "RECURSION_LEVEL_LIMIT_EXCEEDED": 530}
LOG_COLUMNS = [f.name for f in ERROR_LOG.fields]


def error_id(*parts: Column) -> Column:
    """Deterministic id: SHA-256 of the parts joined by U+001F (NULL as U+2400), 32 hex digits."""
    return F.substring(F.sha2(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("\u2400")) for p in parts]),
                              256), 1, 32)


def log_rows(df: DataFrame, *, run_id: str, key: Column, number: Column | int, message: Column | str,
             context: Column | str, severity: int = 16, state: int = 1, procedure: str | None = None,
             line: int | None = None, at: Column | None = None) -> DataFrame:
    """Shape rejected rows as error-log rows (the timestamp is set at write time, unless ``at`` gives it)."""
    lit = lambda v, t: v if isinstance(v, Column) else F.lit(v).cast(t)
    return df.select(
        error_id(F.lit(run_id), key, lit(context, "string")).alias("error_id"),
        lit(number, "int").alias("error_number"), F.lit(severity).cast("int").alias("error_severity"),
        F.lit(state).cast("int").alias("error_state"), F.lit(procedure).cast("string").alias("error_procedure"),
        F.lit(line).cast("int").alias("error_line"), lit(message, "string").alias("error_message"),
        (F.lit(None) if at is None else at).cast("timestamp").alias("error_datetime"), lit(context, "string").alias("process_context"))


@dataclass
class ErrorLog:
    """Append-only log at ``path`` (a folder in shared storage)."""

    spark: SparkSession
    path: str

    def append(self, rows: DataFrame, run_id: str | None = None) -> None:
        """Write log rows; ``error_datetime`` defaults to the write time (GETDATE()). With a
        ``run_id`` they take the place of what an earlier try of that run wrote, by one commit;
        without one they are a run of their own."""
        run = run_id or uuid.uuid4().hex
        out = rows.select(*LOG_COLUMNS).withColumn(
            "error_datetime", F.coalesce(F.col("error_datetime"), F.current_timestamp()))
        self.table.replace_run(out, run)

    @property
    def table(self) -> Committed:
        return Committed(self.spark, self.path, "log_run")

    def read(self, run_id: str | None = None) -> DataFrame:
        """The committed rows (of one run); none if nothing is logged yet, any read error raises."""
        return self.table.read(ERROR_LOG, only=run_id)

    def search(self, context_like: str | None = None, columns: list[str] | None = None) -> DataFrame:
        """Newest first, optionally filtered by ``process_context LIKE``."""
        df = self.read()
        if context_like:
            df = df.filter(F.col("process_context").like(context_like))
        df = df.orderBy(F.col("error_datetime").desc(), F.col("error_id"))
        return df.select(*columns) if columns else df

    def finding(self, message: str, context: str, number: int = 0, severity: int = 0, state: int = 0,
                procedure: str | None = None, line: int | None = None) -> None:
        """A manual investigation finding as one row."""
        one = self.spark.range(1)
        self.append(log_rows(one, run_id="finding", key=F.lit(message), number=number, message=message,
                             context=context, severity=severity, state=state, procedure=procedure, line=line))


class JobFailed(RuntimeError):
    """The clean error re-raised after logging (THROW 50001/50002)."""

    def __init__(self, number: int, message: str):
        super().__init__(f"{number}: {message}")
        self.number = number


# What a strict conversion raises (functions.numeric.strict_number, load_typed).
_CONVERSION = re.compile(r"Error converting data type|Conversion failed when converting")


def _error_number(exc: BaseException) -> int:
    own = getattr(exc, "error_number", None)
    if own is not None:
        return int(own)
    condition = exc.getCondition() if isinstance(exc, PySparkException) else None
    if condition in ERROR_NUMBERS:
        return ERROR_NUMBERS[condition]
    return ERROR_NUMBERS["CAST_INVALID_INPUT"] if _CONVERSION.search(str(exc)) else 50000


# Fixed value: the width of the log's message column.
MESSAGE_WIDTH = 4000


@contextlib.contextmanager
def logged_job(log: ErrorLog, name: str, context: str, number: int = 50001,
               message: str = "Job failed — error logged for investigation."):
    """Run a block of Spark *actions*; on failure log the full context and raise JobFailed.

    Spark is lazy, so the failure surfaces at the action (write, collect) inside the block."""
    try:
        yield
    except Exception as exc:  # noqa: BLE001 - every failure is logged, then re-raised cleanly
        text = (str(exc).strip() or type(exc).__name__)[:MESSAGE_WIDTH]
        one = log.spark.range(1)
        log.append(log_rows(one, run_id=name, key=F.lit(text), number=_error_number(exc), message=text,
                            context=context, severity=16, state=1, procedure=name))
        raise JobFailed(number, message) from exc
