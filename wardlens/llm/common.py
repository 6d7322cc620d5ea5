"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import hashlib
import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_folder, scratch_path, write_bytes


PART_BYTES = 4 << 20  # texts that a task handles at once; results do not depend on it


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, with ``value`` computed once per row (a lambda variable is never
    inlined again by the optimizer, as a projected column would be)."""
    return F.transform(F.array(value), body)[0]


_SHIPPED: set[tuple[str, str]] = set()  # (application, digest) whose executors have this package


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package (as --py-files does), through the shared folder: their Python may not
    have it on its path."""
    root = Path(__file__).resolve().parents[2]
    files = sorted((root / "wardlens").rglob("*.py"))
    if not files:  # run from a zip that the executors already have
        return
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for f in files:
            z.writestr(zipfile.ZipInfo(str(f.relative_to(root))), f.read_bytes())
    data = out.getvalue()
    sc = spark.sparkContext
    digest = hashlib.sha256(data).hexdigest()[:16]
    if (sc.applicationId, digest) in _SHIPPED:
        return
    path = scratch_path(spark, f"code/wardlens-{digest}-{uuid.uuid4().hex}.zip")
    write_bytes(spark, path, data)
    sc.addPyFile(path)
    _SHIPPED.add((sc.applicationId, digest))


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    ship_code(df.sparkSession)
    return df.mapInArrow(run, schema)


def parts(batches: Iterator) -> Iterator:
    """The rows of two-column batches in slices whose second column holds about ``PART_BYTES`` at most, or one row."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(lengths, dtype=np.int64) // PART_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def give_back() -> None:
    """Return freed memory of this Python worker to the machine: workers stay alive between tasks, and two of them share
    an executor's memory with its JVM."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library of Linux
    if trim is not None:
        trim(0)


def hash_sample(df: DataFrame, total: int, n: int, *cols: str) -> DataFrame:
    """About nine tenths of ``n`` rows of a table of ``total`` rows, never more than ``n``: those whose hash of
    ``cols`` is small, whatever the partitions. All rows if they are no more than ``n``. Each task hands
    on its share only (a sorted limit would hand on ``n`` rows per task)."""
    if total > n:
        df = df.filter(F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) < F.lit(int(0.9 * n / total * (1 << 40))))
    return df.limit(n)


_STORED: list[str] = []  # paths that this process has stored and not released


def kept_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted by ``release``."""
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    _STORED.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder of ``spark.checkpoint.dir`` and read back: lineage is cut,
    lost executors lose nothing, and the planner knows the real size of the table. The files stay until
    ``release``: results that are not yet written read them."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _STORED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """A point to release from."""
    return len(_STORED)


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the files stored since a mark, but for the last ``keep``. To call when what was made of them is
    written elsewhere."""
    done = _STORED[since:len(_STORED) - keep]
    del _STORED[since:len(_STORED) - keep]
    for path in done:
        delete_folder(spark, path)
