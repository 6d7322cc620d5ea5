"""Tables whose writes are commits: a manifest says which files count.

A table is a folder of run folders, ``<path>/<part>=<run>/``, written by Spark. ``<path>/_commits/`` holds numbered
manifests; the one with the highest number counts. A manifest names, per run, a list of that run's files. A write
puts its files beside the others, then its file lists, and last the next manifest, by a rename that fails if that number
exists: until then readers see the old rows, from then on the new ones, and a failure at any step leaves one or the
other. Files that no manifest names any more are deleted afterwards; a failure there costs disk, not rows.

Only file names pass through the driver, never rows. Manifests are small: one entry per run, and a file list is written
again only for a run that changes. A folder of runs without a manifest is taken over as it is by the first commit.

With ``keys``, a run also stores the distinct key columns of its rows under ``<path>/_keys/``, in a fixed number of
buckets by the keys' hash, named by the same manifest entry: rows and keys are committed together. A later load reads the
buckets its own keys fall into instead of the table (``existing_keys``).

Two writers of different runs may meet: the slower one's commit fails (``CommitConflict``) and is tried again on
the newer manifest. One run has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from wardlens import session as S

COMMITS, KEYS = "_commits", "_keys"
BUCKETS = 64  # of the key index
TRIES = 10  # commits that meet another writer


class CommitConflict(RuntimeError):
    """Another writer has committed the next manifest."""


class StaleRewrite(RuntimeError):
    """Files that a rewrite replaces are no longer in the table."""


def key_bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(BUCKETS)).cast("int")


class Committed:
    """The table at ``path`` with one folder ``<part>=<run>`` per run."""

    def __init__(self, spark: SparkSession, path: str, part: str = "run_id"):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part

    # manifests

    def manifest(self) -> dict:
        """``version`` and, per run, the name of its lists. Without a manifest: the run folders as they stand."""
        numbers = [int(n.removesuffix(".json")) for n in S.list_names(self.spark, f"{self.path}/{COMMITS}")
                   if n.endswith(".json") and n[:1].isdigit()]
        if numbers:
            return json.loads(S.read_bytes(self.spark, f"{self.path}/{COMMITS}/{max(numbers):012d}.json"))
        head = f"{self.part}="
        return {"version": 0, "runs": {n[len(head):]: None for n in S.list_names(self.spark, self.path) if n.startswith(head)}}

    def _listed(self, folder: str) -> list[str]:
        """Names of the data files below a folder of the table, relative to the table."""
        return [f"{folder}/{n}" for n in S.list_files(self.spark, f"{self.path}/{folder}")]

    def _lists(self, run: str, entry: str | None) -> dict:
        """The files and key files (None: not indexed) of one run."""
        if entry is None:
            return {"files": self._listed(f"{self.part}={run}"), "keys": None}
        return json.loads(S.read_bytes(self.spark, f"{self.path}/{COMMITS}/{entry}"))

    def _commit(self, base: dict, changed: dict[str, dict]) -> None:
        """The manifest after ``base`` with other lists for some runs (no files: the run goes)."""
        runs = dict(base["runs"])
        for run, entry in base["runs"].items():  # folders taken over get their list with the first commit
            if entry is None and run not in changed:
                runs[run] = self._put_lists(self._lists(run, None))
        for run, lists in changed.items():
            runs[run] = self._put_lists(lists)
        version = base["version"] + 1
        data = json.dumps({"version": version, "runs": runs}, sort_keys=True).encode()
        if not S.publish_bytes(self.spark, f"{self.path}/{COMMITS}/{version:012d}.json", data):
            raise CommitConflict(f"version {version} of {self.path} exists")

    def _put_lists(self, lists: dict) -> str:
        name = f"files-{uuid.uuid4().hex}.json"
        S.write_bytes(self.spark, f"{self.path}/{COMMITS}/{name}", json.dumps(lists).encode())
        return name

    def _commit_on_latest(self, changed: dict[str, dict]) -> None:
        for k in range(TRIES):
            try:
                return self._commit(self.manifest(), changed)
            except CommitConflict:
                if k == TRIES - 1:
                    raise

    # reading

    def exists(self) -> bool:
        return bool(self.manifest()["runs"])

    def files(self, without: str | None = None, only: str | None = None) -> list[str]:
        """The files that count, relative to the table."""
        return [f for run, entry in self.manifest()["runs"].items() if run != without and only in (None, run)
                for f in self._lists(run, entry)["files"]]

    def _scan(self, schema: StructType, files: list[str], extra: list[StructField]) -> DataFrame:
        names = {f.name for f in extra}
        whole = StructType([f for f in schema.fields if f.name not in names] + extra)
        if not files:
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).option("basePath", self.path).parquet(*[f"{self.path}/{f}" for f in files])

    def read(self, schema: StructType, without: str | None = None, only: str | None = None) -> DataFrame:
        """The committed rows, of all runs, of all but one, or of one."""
        run = StructField(self.part, StringType())
        extra = [] if any(f.name == self.part for f in schema.fields) else [run]
        files = self.files(without, only)
        if not files:
            return self.spark.createDataFrame([], schema)
        return self._scan(schema, files, extra).select(*[F.col(f"`{n}`") for n in schema.fieldNames()])

    def existing_keys(self, schema: StructType, keys: list[str], wanted: DataFrame, without: str | None = None) -> DataFrame:
        """Key columns of the committed rows, of other runs than ``without``, in the buckets that the keys of
        ``wanted`` fall into. Runs with an index are not scanned; of runs without one (taken over as folders) the
        key columns are."""
        fields = [schema[k] for k in keys]
        indexed, plain = [], []
        for run, entry in self.manifest()["runs"].items():
            if run != without:
                lists = self._lists(run, entry)
                if lists["keys"] is None:
                    plain += lists["files"]
                else:
                    indexed += lists["keys"]
        out = self._scan(StructType(fields), plain, [StructField(self.part, StringType())]).select(*keys)
        if indexed:
            hit = [r[0] for r in wanted.select(key_bucket(keys)).distinct().collect()]  # BUCKETS numbers at most
            index = self._scan(StructType(fields), [f for f in indexed if int(f.rsplit("bucket=", 1)[1].split("/")[0]) in hit],
                               [StructField(self.part, StringType()), StructField("bucket", IntegerType())]).select(*keys)
            out = index if not plain else out.unionByName(index)
        return out

    # writing

    def _write(self, df: DataFrame, folder: str, partition_by: list[str]) -> list[str]:
        """Write beside what a folder of the table holds; the names of the new files."""
        before = set(self._listed(folder))
        writer = df.write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path}/{folder}")
        return [f for f in self._listed(folder) if f not in before]

    def _write_keys(self, run: str, keys: list[str], rows: DataFrame) -> list[str]:
        index = rows.select(*keys).distinct().withColumn("bucket", key_bucket(keys)).repartition(BUCKETS, "bucket")
        return self._write(index, f"{KEYS}/{self.part}={run}", ["bucket"])

    def replace_run(self, df: DataFrame, run: str, partition_col: str | None = None, keys: list[str] | None = None) -> None:
        """Write a run's rows (and the index of their keys) in place of what the run wrote before."""
        folder = f"{self.part}={run}"
        new = {"files": self._write(df, folder, [partition_col] if partition_col else []), "keys": None}
        if keys:
            new["keys"] = self._write_keys(run, keys, self._scan(df.schema, new["files"], []))
        self._commit_on_latest({run: new})
        self._clean([run])

    def delete(self, schema: StructType, predicate: Column, partition_col: str | None = None, keys: list[str] | None = None) -> dict:
        """S13, ``DELETE ... WHERE predicate`` (NULL keeps the row): only files that hold a matching row are written
        again, without those rows; all others stay as they are. ``files`` rewritten and ``rows`` deleted."""
        base = self.manifest()
        lists = {run: self._lists(run, entry) for run, entry in base["runs"].items()}
        live = [f for entry in lists.values() for f in entry["files"]]
        run = StructField(self.part, StringType())
        rows = self._scan(schema, live, [run])
        gone = F.coalesce(predicate, F.lit(False))
        found = (rows.filter(gone).groupBy(F.col("_metadata.file_path").alias("file")).count().collect() if live else [])
        hit = {self._relative(r["file"]): r["count"] for r in found}  # names of files, not rows
        self._rewrite(base, lists, set(hit), self._scan(schema, list(hit), [run]).filter(~gone), schema, partition_col, keys)
        return {"files": len(hit), "rows": sum(hit.values())}

    def _rewrite(self, base: dict, lists: dict[str, dict], hit: set[str], rows: DataFrame, schema: StructType,
                 partition_col: str | None, keys: list[str] | None) -> None:
        """Commit ``rows`` (with their run) in place of the files ``hit``; other files stay. With ``keys`` the index
        of the runs concerned is written again, else they keep theirs."""
        changed = {r: entry for r, entry in lists.items() if any(f in hit for f in entry["files"])}
        if not changed:
            return
        before = {r: set(self._listed(f"{self.part}={r}")) for r in changed}
        rows.write.mode("append").partitionBy(self.part, *([partition_col] if partition_col else [])).parquet(self.path)
        for r in changed:
            files = [f for f in changed[r]["files"] if f not in hit]
            files += [f for f in self._listed(f"{self.part}={r}") if f not in before[r]]
            index = self._write_keys(r, keys, self._scan(schema, files, [])) if keys else lists[r]["keys"]
            changed[r] = {"files": files, "keys": index}
        try:
            self._commit(base, changed)
        except CommitConflict:  # other runs may have been added meanwhile, these must be as they were
            now = self.manifest()["runs"]
            if any(now.get(r, "") != base["runs"][r] for r in changed):
                raise StaleRewrite(f"runs {sorted(changed)} of {self.path} have changed") from None
            self._commit_on_latest(changed)
        self._clean(list(changed))

    def file_sizes(self, schema: StructType) -> DataFrame:
        """``file`` (relative), ``folder`` and ``bytes`` of every file that counts and has rows, from the scan's metadata."""
        base = unquote(urlparse(S.qualified(self.spark, self.path)).path).rstrip("/")
        names = self.spark.createDataFrame([], "file string, bytes bigint")
        files = self.files()
        if files:
            names = (self._scan(schema, files, [StructField(self.part, StringType())])
                     .groupBy(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_size").alias("bytes")).count())
            path = F.url_decode(F.replace(F.regexp_replace("uri", "^[a-z0-9]+:(//[^/]*)?/", "/"), F.lit("+"), F.lit("%2B")))
            names = names.select(F.substring(path, len(base) + 2, 1 << 30).alias("file"), "bytes")
        return names.withColumn("folder", F.regexp_extract("file", "^(.*)/[^/]+$", 1))

    def compact(self, schema: StructType, folders: list[str], pieces: int, order: list[str], partition_col: str | None = None) -> int:
        """Write the files of some folders again as about ``pieces`` files, sorted by ``order`` inside; the rows stay
        in their folders and runs. The number of files that went."""
        base = self.manifest()
        lists = {run: self._lists(run, entry) for run, entry in base["runs"].items()}
        wanted = set(folders)
        hit = {f for entry in lists.values() for f in entry["files"] if f.rsplit("/", 1)[0] in wanted}
        rows = self._scan(schema, sorted(hit), [StructField(self.part, StringType())])
        keys = [self.part, *([partition_col] if partition_col else []), *order]
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
        self._rewrite(base, lists, hit, rows.repartitionByRange(max(pieces, 1), *keys, spread).sortWithinPartitions(*keys),
                      schema, partition_col, None)
        return len(hit)

    def _relative(self, file: str) -> str:
        base = unquote(urlparse(S.qualified(self.spark, self.path)).path).rstrip("/")
        return unquote(urlparse(file).path)[len(base) + 1:]

    def _clean(self, runs: list[str]) -> None:
        """Delete files in the folders of these runs that the latest manifest does not name."""
        now = self.manifest()["runs"]
        for run in runs:
            lists = self._lists(run, now[run])
            for folder, kept in ((f"{self.part}={run}", lists["files"]), (f"{KEYS}/{self.part}={run}", lists["keys"] or [])):
                for f in set(self._listed(folder)) - set(kept):
                    S.delete_folder(self.spark, f"{self.path}/{f}")
