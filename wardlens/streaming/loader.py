"""Defensive loading of arriving files with Structured Streaming (the nightly load of the
reference, run continuously): each micro-batch goes through the same set-based rules as a batch
load (``load_constrained`` / ``load_typed``) inside ``foreachBatch``.

Exactly-once in practice: every epoch owns one folder of the target and one of the log, so a
replayed epoch (after a driver restart) replaces its output instead of appending it twice. The source
offsets live in ``checkpoint_location`` (shared storage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wardlens.operators.errorlog import ErrorLog
from wardlens.operators.load import Constraints, run_constrained_load, run_typed_load


def stream_constrained_load(spark: SparkSession, source: DataFrame, target_path: str, log_path: str,
                            checkpoint_location: str, rules: Constraints, order_cols: list[str],
                            name_col: str = "patient_name", query_name: str = "constrained_load",
                            trigger_once: bool = True, partition_col: str | None = None) -> StreamingQuery:
    """Run ``load_constrained`` on every micro-batch of the streaming ``source``.

    Rows already in the target (other epochs) count as existing for the UNIQUE rule. Give
    ``partition_col`` (a column of the unique key, such as the admission date) to lay the target
    out by it: the semi-join on the batch's keys then prunes partitions at run time."""
    log = ErrorLog(spark, log_path)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        run_constrained_load(batch, rules, order_cols, target_path, log, name_col, f"{query_name}-{epoch_id}",
                             part="epoch", partition_col=partition_col)

    writer = source.writeStream.queryName(query_name).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.foreachBatch(per_batch).start()


def stream_typed_load(spark: SparkSession, source: DataFrame, target_path: str, log_path: str,
                      checkpoint_location: str, conversions: dict[str, str] | None = None, *, key_col: str,
                      name_col: str = "name", query_name: str = "typed_load", trigger_once: bool = True) -> StreamingQuery:
    """Run ``load_typed`` (row-routed conversion) on every micro-batch of ``source``."""
    log = ErrorLog(spark, log_path)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        run_typed_load(batch, target_path, log, conversions, key_col=key_col, name_col=name_col,
                       run_id=f"{query_name}-{epoch_id}", part="epoch")

    writer = source.writeStream.queryName(query_name).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.foreachBatch(per_batch).start()
