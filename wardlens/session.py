"""Session helpers: a tuned local/cluster session and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins (broadcast when the runtime size is
# under autoBroadcastJoinThreshold), splits skewed shuffle partitions and coalesces small ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of a finished lineage are removed when their RDD is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def scale_conf(input_bytes: int, partition_bytes: int = 512 * 1024 * 1024) -> dict:
    """Shuffle sizing for a given input: enough initial partitions that each holds at most
    ``partition_bytes`` (so a task's shuffle block fits in executor memory without heavy spill);
    AQE coalesces the small ones at run time. 100 TB gives about 190,000 partitions."""
    n = max(8, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 4),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes // 2),
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "wardlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the scale settings above.

    ``master`` defaults to ``local[$BENCH_CPUS]`` or ``local[*]``; on a cluster pass None and let
    spark-submit decide (the builder keeps an existing master).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not os.environ.get("SPARK_MASTER"):
        cpus = os.environ.get("BENCH_CPUS")
        master = f"local[{cpus}]" if cpus else "local[*]"
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local-mode session with no folder configured gets a fresh temporary one; a cluster
    session without the setting is an error, since a machine-local folder would not survive
    the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: configure a shared folder for the cluster")
    folder = tempfile.mkdtemp(prefix="wardlens-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/wardlens/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared folder, survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in the store that Spark reads (any other failure raises)."""
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file in the store that Spark reads."""
    fs, target = _file_system(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this library."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file of the store that Spark reads."""
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def publish_bytes(spark: SparkSession, path: str, data: bytes) -> bool:
    """A small file that appears whole or not at all, and only if there is none of that name (else False)."""
    written = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
    write_bytes(spark, written, data)
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    _, source = _file_system(spark, written)
    _, target = _file_system(spark, path)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(source, target, options)
    except Py4JJavaError as e:
        delete_folder(spark, written)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark names files below it."""
    fs, target = _file_system(spark, path)
    return fs.makeQualified(target).toUri().toString()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, target = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Data files below a folder, relative to it: no name on the way begins with _ or . (as for Spark's readers)."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    base, out, found = fs.makeQualified(target).toUri().getPath().rstrip("/"), [], fs.listFiles(target, True)
    while found.hasNext():
        name = found.next().getPath().toUri().getPath()[len(base) + 1:]
        if not any(part[0] in "_." for part in name.split("/")):
            out.append(name)
    return sorted(out)
