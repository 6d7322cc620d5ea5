"""Parent-pointer hierarchies: referral chains walked from the roots.

``walk_hierarchy`` is a frontier loop: level k+1 is one distributed equi-join of the edge table
with level k. The driver only asks whether the new level is empty. Each level is written as a
reliable checkpoint in the shared folder, so lineage stays one level deep and a lost executor
costs one level, not the whole walk.

Limits, as in a recursive CTE: ``max_recursion`` counts recursive rounds (depth can reach
``max_recursion + 1``); a walk that still has rows to expand after that many rounds fails with
:class:`RecursionLimitExceeded`, never with a silently incomplete result. ``depth_guard``
is the inline ``WHERE depth < n`` guard: rows at depth ``n`` are not expanded, silently.

``walk_by_doubling`` gives the same rows for unique ids in about log2(depth) rounds: every row's pointer jumps to
its ancestor's ancestor, and depths and paths are put together from the two halves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.session import cut_lineage


class RecursionLimitExceeded(RuntimeError):
    """The walk did not terminate within the allowed number of recursive rounds."""

    error_number = 530

    def __init__(self, message: str, max_recursion: int | None = None, unfinished: int | None = None):
        super().__init__(message)
        self.max_recursion = max_recursion
        self.unfinished = unfinished  # rows of the first round beyond the limit


def _no_parent(cols) -> Column:
    """A (composite) parent reference with any NULL part points nowhere, as a SQL foreign key."""
    cond = None
    for c in cols:
        x = F.col(c).isNull()
        cond = x if cond is None else cond | x
    return cond


def roots(df: DataFrame, parent_cols=("parent_referral_id",)) -> DataFrame:
    """H4: rows without a parent."""
    return df.filter(_no_parent(parent_cols))


def parent_links(df: DataFrame, id_cols=("referral_id",), parent_cols=("parent_referral_id",),
                 parent_alias: str = "parent_id") -> DataFrame:
    """H5: each child with its parent's id; rows whose parent is missing drop out (inner join)."""
    parent = df.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(id_cols)])
    cond = None
    for i, pc in enumerate(parent_cols):
        x = df[pc] == parent[f"_p{i}"]
        cond = x if cond is None else cond & x
    out = df.join(parent, cond, "inner")
    if len(id_cols) == 1:
        return out.withColumnRenamed("_p0", parent_alias).drop(*[f"_p{i}" for i in range(1, len(id_cols))])
    return out.withColumn(parent_alias, F.struct(*[F.col(f"_p{i}") for i in range(len(id_cols))])).drop(
        *[f"_p{i}" for i in range(len(id_cols))])


def walk_hierarchy(df: DataFrame, id_cols=("referral_id",), parent_cols=("parent_referral_id",),
                   root_label: str = "patient_name", step_label: str = "to_department",
                   max_recursion: int = 50, depth_guard: int | None = None,
                   start: Column | None = None, path_col: str = "referral_path", separator: str = " > ",
                   checkpoint: bool = True) -> DataFrame:
    """H1-H3: every row reachable from the start rows, with ``depth`` (from 1) and a path
    ``root_label > step > step ...``. ``start`` defaults to the roots (a parent column NULL).

    The recursive step joins ``child.parent_cols = frontier.id_cols`` (equi-join on the id, so
    at most one parent per child: no pairing within a group). String concatenation propagates
    NULL, like ``+`` on text in the reference."""
    id_cols, parent_cols = list(id_cols), list(parent_cols)
    table = None
    if checkpoint:
        # The edges are written once as a managed table bucketed by the parent key (in the shared
        # warehouse; dropped with its files at the end): each level's join then reads them without a
        # shuffle and moves only the frontier. (A checkpoint would not keep the partitioning.)
        df, table = _bucketed_edges(df, parent_cols)
    try:
        return _walk(df, id_cols, parent_cols, root_label, step_label, max_recursion, depth_guard,
                     start, path_col, separator, checkpoint)
    finally:
        if table:
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")


def _bucketed_edges(df: DataFrame, parent_cols: list[str]) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    name = f"wardlens_edges_{uuid.uuid4().hex}"
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                  int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    # dealt out by the bucket key first: one file per bucket, not one per task and bucket
    (df.repartition(buckets, *parent_cols).write.bucketBy(buckets, *parent_cols).sortBy(*parent_cols)
       .saveAsTable(name))
    return spark.table(name), name


def _walk(df, id_cols, parent_cols, root_label, step_label, max_recursion, depth_guard, start, path_col,
          separator, checkpoint) -> DataFrame:
    start_rows = df.filter(start if start is not None else _no_parent(parent_cols))
    level = start_rows.select(*df.columns, F.lit(1).alias("depth"),
                              F.concat(F.col(root_label), F.lit(separator), F.col(step_label)).alias(path_col))
    if checkpoint:
        level = cut_lineage(level)
    levels = [level]
    rounds = 0
    while True:
        frontier = level if depth_guard is None else level.filter(F.col("depth") < depth_guard)
        carried = frontier.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(id_cols)],
                                  F.col("depth").alias("_d"), F.col(path_col).alias("_path"))
        cond = None
        for i, pc in enumerate(parent_cols):
            x = df[pc] == carried[f"_k{i}"]
            cond = x if cond is None else cond & x
        nxt = df.join(carried, cond, "inner").select(
            *[df[c] for c in df.columns], (F.col("_d") + 1).alias("depth"),
            F.concat(F.col("_path"), F.lit(separator), df[step_label]).alias(path_col))
        if checkpoint:
            nxt = cut_lineage(nxt)
        if nxt.isEmpty():
            break
        rounds += 1
        if rounds > max_recursion:
            raise RecursionLimitExceeded(
                f"The statement terminated. The maximum recursion {max_recursion} has been exhausted "
                f"before statement completion.", max_recursion, nxt.count())
        levels.append(nxt)
        level = nxt
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


def walk_by_doubling(df: DataFrame, id_cols=("referral_id",), parent_cols=("parent_referral_id",),
                     root_label: str = "patient_name", step_label: str = "to_department", max_recursion: int = 50,
                     depth_guard: int | None = None, path_col: str = "referral_path", separator: str = " > ") -> DataFrame:
    """H1-H3 from the roots, for ids that do not repeat: the rows, depths, paths and limits of ``walk_hierarchy``.

    Each row holds a pointer to an ancestor, the number of steps to it and the path between. A round looks up the
    pointer's own pointer (one equi-join on the id, so one match per row; AQE splits the rows below one ancestor), adds
    the steps and joins the paths: after k rounds a pointer has gone 2^k steps or has arrived at a root. Rows that have
    arrived are not looked up again. Each round is one reliable checkpoint. Rows below a missing parent or on a cycle
    never arrive and are left out, as in a walk from the roots; they cost rounds up to log2 of the number of rows."""
    id_cols, parent_cols = list(id_cols), list(parent_cols)
    labels = [F.col(root_label), F.lit(separator), F.col(step_label)]
    root = _no_parent(parent_cols)
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(id_cols)]
    state = cut_lineage(df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *keys,
        *[F.when(~root, F.col(c)).alias(f"_a{i}") for i, c in enumerate(parent_cols)], root.alias("_done"),
        F.when(root, 0).otherwise(1).alias("_steps"), F.when(root, F.concat(*labels)).otherwise(F.concat(*labels[1:])).alias("_path")))
    known = [F.col(f"_k{i}") for i in range(len(id_cols))]
    counted = state.filter(~_no_parent([f"_k{i}" for i in range(len(id_cols))])).groupBy(*known).count()
    if not counted.filter("count > 1").isEmpty():
        raise ValueError("ids repeat: a row may have several parents, use walk_hierarchy")
    reach = state.count()  # no path is longer
    if depth_guard is not None:
        reach = min(reach, depth_guard)
    gone = 1
    while gone < reach and not state.filter("not _done").isEmpty():
        up = state.select(*[F.col(f"_k{i}").alias(f"_u{i}") for i in range(len(id_cols))],
                          *[F.col(f"_a{i}").alias(f"_b{i}") for i in range(len(id_cols))],
                          F.col("_done").alias("_up_done"), F.col("_steps").alias("_up_steps"), F.col("_path").alias("_up_path"))
        going, cond = state.filter("not _done"), None
        for i in range(len(id_cols)):
            x = going[f"_a{i}"] == up[f"_u{i}"]
            cond = x if cond is None else cond & x
        # an inner join: rows below a missing parent drop out
        moved = going.join(up, cond).select(
            "_row", *known, *[F.col(f"_b{i}").alias(f"_a{i}") for i in range(len(id_cols))], F.col("_up_done").alias("_done"),
            (F.col("_steps") + F.col("_up_steps")).alias("_steps"), F.concat("_up_path", "_path").alias("_path"))
        state = cut_lineage(state.filter("_done").unionByName(moved))
        gone *= 2
        deep = F.col("_done") & (F.col("_steps") > max_recursion)
        if depth_guard is not None:
            deep = deep & (F.col("_steps") < depth_guard)
        over = state.filter(deep & (F.col("_steps") == max_recursion + 1)).count()
        if over:
            raise RecursionLimitExceeded(
                f"The statement terminated. The maximum recursion {max_recursion} has been exhausted "
                f"before statement completion.", max_recursion, over)
    done = state.filter("_done")
    if depth_guard is not None:
        done = done.filter(F.col("_steps") < depth_guard)
    return done.select("_row.*", (F.col("_steps") + 1).alias("depth"), F.col("_path").alias(path_col))
