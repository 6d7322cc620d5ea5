"""Data layout for filter-heavy reports: the Spark counterpart of a covering
index is a parquet table partitioned by the equality filter column and sorted by the next one,
so partition pruning, row-group min/max skipping and column pruning do the work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardlens.sources.committed import Committed


def write_layout(df: DataFrame, path: str, partition_by=("admission_type",), sort_by=("medical_condition",),
                 target_files: int | None = None) -> None:
    """Write ``df`` partitioned by ``partition_by`` and sorted by ``sort_by`` inside each file.

    ``repartitionByRange`` on (partition, sort, row hash) samples the data: a partition value
    holding most rows is split over several tasks (hash repartitioning on the partition column
    would put it in one), and the trailing row hash splits even a single (partition, sort) key
    that holds a third of the table. Inside each file the rows are sorted by the keys, which is
    what row-group min/max skipping needs."""
    keys = list(partition_by) + list(sort_by)
    n = target_files or df.sparkSession.sparkContext.defaultParallelism
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    (df.repartitionByRange(n, *[F.col(k) for k in keys], spread).sortWithinPartitions(*keys)
       .write.mode("overwrite").partitionBy(*partition_by).parquet(path))


# The maintenance bands of the reference (percent): above 30 rebuild, 10..30 reorganise.
def health_band(pct_col):
    return (F.when(pct_col > 30, "REBUILD recommended").when(pct_col.between(10, 30), "REORGANISE recommended")
             .otherwise("OK — no action needed"))


def layout_health(spark: SparkSession, path: str, small_file_bytes: int = 32 * 1024 * 1024) -> DataFrame:
    """Per partition folder: files, bytes, share of small files and the recommended action.

    File sizes come from the ``_metadata`` column of the scan, aggregated by Spark (no driver
    listing loop)."""
    df = spark.read.parquet(path)
    files = (df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
               .groupBy("file_path").agg(F.max("file_size").alias("file_size")))
    part = F.regexp_extract("file_path", r"^(.*)/[^/]+$", 1)
    from wardlens.functions.numeric import pct
    return (files.groupBy(part.alias("partition"))
                 .agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"),
                      F.count_if(F.col("file_size") < small_file_bytes).alias("small_files"))
                 .withColumn("small_file_pct", pct(F.col("small_files"), F.col("files")))
                 .withColumn("recommended_action", health_band(F.col("small_file_pct"))))


def table_health(table: Committed, schema: StructType, small_file_bytes: int = 32 * 1024 * 1024) -> DataFrame:
    """Y5 for a committed table: per folder its files, bytes, small files and the recommended action."""
    from wardlens.functions.numeric import pct
    return (table.file_sizes(schema).groupBy(F.col("folder").alias("partition"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"),
                 F.count_if(F.col("bytes") < small_file_bytes).alias("small_files"))
            .withColumn("small_file_pct", pct(F.col("small_files"), F.col("files")))
            .withColumn("recommended_action", health_band(F.col("small_file_pct"))))


def rebuild(table: Committed, schema: StructType, order: list[str], partition_col: str | None = None,
            target_bytes: int = 128 * 1024 * 1024, small_file_bytes: int = 32 * 1024 * 1024) -> dict:
    """Y5 acted on: folders marked REBUILD that hold more than one small file are written again with files of about
    ``target_bytes``, by one commit; all others keep their files. ``folders`` rebuilt and ``files`` that went.

    Rows are dealt out by range over (folder, order): a piece is about the target's size, a folder of several
    pieces is cut, small folders share a task. A folder of one file cannot be made less fragmented and stays."""
    marked = (table_health(table, schema, small_file_bytes)
              .filter(F.col("recommended_action").startswith("REBUILD") & (F.col("files") > 1)).select("partition", "bytes").collect())
    if not marked:
        return {"folders": 0, "files": 0}
    pieces = -(-sum(r["bytes"] for r in marked) // target_bytes)
    return {"folders": len(marked), "files": table.compact(schema, [r["partition"] for r in marked], pieces, order, partition_col)}


def interleaved(df: DataFrame, first: str, second: str, bits: int = 5) -> tuple[DataFrame, str]:
    """``df`` with ``_z``: the bits of both columns' places in their own order, in turns. Rows with near values of
    ``_z`` are near in both columns. A place is one of 2^bits equal shares of the rows, from approximate
    quantiles (for text of its leading 6 bytes), so the split points are few however large the table is."""
    def measure(c: str) -> Column:
        if dict(df.dtypes)[c] == "string":
            return F.conv(F.hex(F.rpad(F.encode(F.col(c), "UTF-8"), 6, F.lit(b"\x00"))), 16, 10).cast("double")
        return F.col(c).cast("double")

    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(measure(c), shares, 10_000).alias(c) for c in (first, second)]).first()
    z = F.lit(0).cast("bigint")
    for k, c in enumerate((first, second)):
        place = F.coalesce(sum((measure(c) > cut).cast("int") for cut in sorted(set(cuts[c] or []))) + F.lit(0), F.lit(0)).cast("bigint")
        for b in range(bits):
            bit = F.shiftright(place, b).bitwiseAND(F.lit(1))
            z = z + F.shiftleft(bit, 2 * b + 1 - k)
    return df.withColumn("_z", z), "_z"


def write_point_lookup_layout(df: DataFrame, path: str, first: str, second: str, files: int, bits: int = 5) -> None:
    """Files that a filter on either column can skip. Rows are clustered by the interleaved order of both
    columns, so each file spans a part of either column's values (min/max skipping), and each file has a Parquet
    Bloom filter on both, which settles values inside that span."""
    placed, z = interleaved(df, first, second, bits)
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    writer = placed.repartitionByRange(files, z, spread).sortWithinPartitions(z, first, second).drop(z).write.mode("overwrite")
    for c in (first, second):
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def scan_evidence(df: DataFrame) -> dict:
    """What a query reads: input files and the filters and columns pushed into the scan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = [ln.strip() for ln in plan.splitlines() if "PushedFilters" in ln or "PartitionFilters" in ln]
    return {"input_files": len(df.inputFiles()), "scan": pushed}
