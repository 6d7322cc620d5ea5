"""Minimum-cost-flow resharding.

Given the old shard of every document and a new number of shards, every new shard gets q documents or one more (their
counts are at most one apart), and the documents to move are found by a minimum-cost flow in which a unit is a document
and its cost the bytes it moves:

    (old shard, size class) --0--> the same new shard          (the documents stay)
    (old shard, size class) --bytes--> hub                     (they move)
    hub --0--> each new shard; each new shard --0, q--> sink, --0, 1--> remainder --0, documents left--> sink

The cost of moving does not depend on the destination, so one hub stands for all pairs of shards. The size classes of an old
shard are cut where its q largest documents end: sizes above that of the q-th largest document, equal to it, equal
to the next one's, and below. Of the two inner classes all documents have one size, and no other class is divided by a
cheapest flow, so the flow moves the fewest bytes exactly, the remainder included. The graph has four classes per old shard:
it is bounded by the shard counts, not by the data. The driver solves it on the class sums; which document goes
where follows on Spark from its rank in its class. Block transfers (old shard, new shard, documents, bytes) are the
flow read as intervals of ranks.

The cuts come from counts per (old shard, size), which are as many as there are sizes. Ranks are found without a global sort
and without sending a shard to one task: each (old shard, size class) is cut into blocks of about ``block_rows`` rows by a
hash of the document, the blocks are counted (partial aggregates), their offsets are running sums over blocks, and
rows are numbered within their block.

The query carries the plan out: the documents (whole rows) are written as the old layout, a folder per shard, and every
shard that gains or loses a document is written again with its new documents in place; the other shards keep their files.
The result is read from the shards' files: sizes and checksums are those of the texts found there.

Defined results: a null text has 16 bytes and the checksum of the empty text; rows with equal ids are documents
of their own (the query numbers rows, so that many equal ones spread over blocks); a null source is a source
of its own; an empty table gives an empty result; other columns are carried along in the files.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept_path, stored

HEADER = 16  # fixed value: bytes of a document beside its text


class Flow:
    """Minimum-cost flow by successive shortest paths with potentials (integer capacities and costs)."""

    def __init__(self, n: int):
        self.edges: list[list[int]] = []  # to, capacity left, cost; the reverse edge is at index ^ 1
        self.out: list[list[int]] = [[] for _ in range(n)]

    def add(self, a: int, b: int, capacity: int, cost: int) -> int:
        self.out[a].append(len(self.edges))
        self.edges.append([b, capacity, cost])
        self.out[b].append(len(self.edges))
        self.edges.append([a, 0, -cost])
        return len(self.edges) - 2

    def sent(self, edge: int) -> int:
        return self.edges[edge ^ 1][1]

    def run(self, source: int, sink: int) -> tuple[int, int]:
        """Flow and cost of the cheapest maximum flow."""
        high = [0] * len(self.out)
        flow = cost = 0
        while True:
            best, via = {source: 0}, {}
            heap, done = [(0, source)], set()
            while heap:
                d, a = heapq.heappop(heap)
                if a in done:
                    continue
                done.add(a)
                for e in self.out[a]:
                    b, left, c = self.edges[e]
                    if left > 0 and b not in done:
                        new = d + c + high[a] - high[b]
                        if new < best.get(b, new + 1):
                            best[b], via[b] = new, e
                            heapq.heappush(heap, (new, b))
            if sink not in best:
                return flow, cost
            far = max(best.values())
            for v in range(len(self.out)):
                high[v] += best.get(v, far)
            path, v = [], sink
            while v != source:
                path.append(via[v])
                v = self.edges[via[v] ^ 1][0]
            push = min(self.edges[e][1] for e in path)
            for e in path:
                self.edges[e][1] -= push
                self.edges[e ^ 1][1] += push
                cost += push * self.edges[e][2]
            flow += push


@dataclass
class Plan:
    """How many documents of each (old shard, class) stay, and the capacities of the new shards."""
    capacity: list[int]
    stay: dict[tuple[int, int], int]
    moved_bytes: int


def solve(sums: dict[tuple[int, int], tuple[int, int]], n_new: int) -> Plan:
    """``sums``: (old shard, class) -> (documents, bytes)."""
    total = sum(n for n, _ in sums.values())
    source, sink, hub, remainder, first = 0, 1, 2, 3, 4 + n_new
    keys = sorted(sums)
    g = Flow(first + len(keys))
    g.add(remainder, sink, total % n_new, 0)
    more = []
    for s in range(n_new):
        g.add(4 + s, sink, total // n_new, 0)
        more.append(g.add(4 + s, remainder, 1, 0))
        g.add(hub, 4 + s, total // n_new + 1, 0)
    stays = {}
    for k, (old, c) in enumerate(keys):
        n, size = sums[old, c]
        g.add(source, first + k, n, 0)
        if old < n_new:
            stays[old, c] = g.add(first + k, 4 + old, n, 0)
        g.add(first + k, hub, n, -(-size // n))
    flow, _ = g.run(source, sink)
    assert flow == total
    stay = {key: g.sent(stays[key]) if key in stays else 0 for key in keys}
    # a divided class holds documents of one size
    moved = sum(size * (n - stay[k]) // n for k, (n, size) in sums.items())
    return Plan([total // n_new + g.sent(e) for e in more], stay, moved)


def text_bytes(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long")


def size_cuts(docs: DataFrame, q: int) -> DataFrame:
    """``old_shard``, ``cut`` and ``next``: the sizes of its q-th and (q + 1)-th largest document (null: it has fewer)."""
    above = Window.partitionBy("old_shard").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    sizes = (docs.groupBy("old_shard", "size").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("upto", F.sum("n").over(above)))
    return sizes.groupBy("old_shard").agg(F.max(F.when(F.col("upto") >= q, F.col("size"))).alias("cut") if q else
                                          F.lit(None).cast("long").alias("cut"),
                                          F.max(F.when(F.col("upto") > q, F.col("size"))).alias("next"))


def reshard(docs: DataFrame, n_new: int, key: list[Column], block_rows: int = 2_000) -> DataFrame:
    """The input (columns ``old_shard`` int from 0 and ``size`` long required) plus ``shard``, ``slot``
    (gapless from 0 in each new shard: the documents that stay come first) and ``moved``. ``key`` are the columns
    whose hash deals documents to blocks and whose order breaks ties."""
    spark = docs.sparkSession
    cuts = stored(size_cuts(docs, docs.count() // n_new), "cuts")  # bounded: a row per old shard
    size = F.col("size")
    rows = docs.join(F.broadcast(cuts), "old_shard").withColumn(
        "class", F.when(size > F.col("cut"), 0).when(size == F.col("cut"), 1).when(size == F.col("next"), 2)
        .when(size < F.col("next"), 3).otherwise(0)).drop("cut", "next")
    by_group = ["old_shard", "class"]
    found = rows.groupBy(*by_group).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect()
    sums = {(r["old_shard"], r["class"]): (r["n"], r["bytes"]) for r in found}  # bounded: four rows per old shard
    dealt = spark.createDataFrame([(old, c, max(1, -(-n // block_rows))) for (old, c), (n, _) in sorted(sums.items())],
                                  "old_shard int, class int, blocks bigint")
    rows = rows.join(F.broadcast(dealt), by_group).withColumn("block", F.pmod(F.xxhash64(*key), F.col("blocks"))).drop("blocks")
    group = ["old_shard", "class", "block"]
    counted = stored(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n")), "blocks")
    plan = solve(sums, n_new)

    # where the stayers of a class begin in their shard, and its movers in the hub's stream
    slots, hub, table = [0] * n_new, 0, []
    for old, c in sorted(sums):
        stay = plan.stay[old, c]
        table.append((old, c, stay, slots[old] if old < n_new else 0, hub))
        if old < n_new:
            slots[old] += stay
        hub += sums[old, c][0] - stay
    by_class = spark.createDataFrame(
        table, "old_shard int, class int, stay bigint, slot_from bigint, hub_from bigint")
    # the hub's stream is dealt to the new shards in order: [begin, begin + free)
    begin, deal = 0, []
    for s in range(n_new):
        free = plan.capacity[s] - slots[s]
        deal.append((s, begin, slots[s]))
        begin += free
    offsets = (counted.withColumn("before", F.sum("n").over(
        Window.partitionBy("old_shard", "class").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
        .join(F.broadcast(by_class), by_group)  # bounded: four rows per old shard
        .select(*group, F.coalesce("before", F.lit(0)).alias("before"), "stay", "slot_from", "hub_from"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*key)) - 1 + F.col("before")
    placed = (rows.join(offsets, group).withColumn("rank", rank)
              .withColumn("moved", F.col("rank") >= F.col("stay"))
              .withColumn("at", F.col("hub_from") + F.col("rank") - F.col("stay")))
    # the new shard of a place in the stream is the last one that begins at or before it and is not full
    free = [(s, b, f) for (s, b, f), nxt in zip(deal, [*(d[1] for d in deal[1:]), begin], strict=True) if nxt > b]
    arrived = F.lit(None).cast("struct<shard:int,begin:bigint,first:bigint>")
    for s, b, f in free:  # n_new branches at most
        arrived = F.when(F.col("at") >= b, F.struct(
            F.lit(s).alias("shard"), F.lit(b).cast("long").alias("begin"), F.lit(f).cast("long").alias("first"))
        ).otherwise(arrived)
    placed = placed.withColumn("to", F.when(F.col("moved"), arrived))
    return (placed
            .withColumn("shard", F.when(F.col("moved"), F.col("to.shard")).otherwise(F.col("old_shard")).cast("int"))
            .withColumn("slot", F.when(F.col("moved"), F.col("to.first") + F.col("at") - F.col("to.begin"))
                        .otherwise(F.col("slot_from") + F.col("rank")).cast("long"))
            .drop("class", "block", "before", "stay", "slot_from", "hub_from", "rank", "at", "to"))


def transfers(placed: DataFrame) -> DataFrame:
    """The block transfers: documents and bytes that go from an old shard to another new one."""
    return (placed.filter("moved").groupBy("old_shard", "shard")
            .agg(F.count(F.lit(1)).alias("documents"), F.sum("size").alias("bytes")))


def rewrite_affected(placed: DataFrame, path: str) -> list[int]:
    """Write every shard that gains or loses a document as Parquet under ``path`` (one folder per shard) and
    return their numbers; the other shards' files stay as they are."""
    moved = placed.filter("moved")
    touched = sorted({r[0] for r in moved.select(F.col("old_shard")).distinct()
                      .union(moved.select("shard").distinct()).distinct().collect()})  # bounded by the shard counts
    _write_shards(placed.filter(F.col("shard").isin(touched)), "shard", path)
    return touched


def _write_shards(rows: DataFrame, by: str, path: str) -> None:
    (rows.write.partitionBy(by).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").parquet(path))


def old_layout(source: Column, shards: int) -> Column:
    """The layout that resharding starts from: a shard for each source, as a crawl writes it."""
    return F.pmod(F.crc32(F.coalesce(source, F.lit("")).cast("binary")), F.lit(shards)).cast("int")


def sharded(docs: DataFrame, shards: int) -> DataFrame:
    """The documents as they lie in the new shards' files: ``document`` (a struct of the input's columns), ``shard``, ``slot``,
    ``old_shard`` and ``moved``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"),
                       (text_bytes(F.col("text")) + HEADER).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       old_layout(F.col("source"), shards).alias("old_shard"), F.monotonically_increasing_id().alias("tag"))
    old, new = kept_path(spark, "old-shards"), kept_path(spark, "new-shards")
    _write_shards(rows, "old_shard", old)
    rows = spark.read.schema(rows.schema).parquet(old)
    placed = reshard(rows, shards, [F.col("document.doc_id"), F.col("text_crc32"), F.col("size"), F.col("tag")]).select(
        "document", "shard", "slot", "old_shard", "moved", "size")
    touched = rewrite_affected(placed, new)
    if not touched:
        return placed.drop("size")
    out = spark.read.schema(placed.schema).parquet(new)
    if len(touched) < shards:
        out = out.unionByName(placed.filter(~F.col("old_shard").isin(touched)))  # their files have stayed
    return out.drop("size")


def shard_rows(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row per document, resharded from the layout by source under the law of rows, as read from the shards' files; a
    document that moved with the documents and bytes of the block transfer it belongs to."""
    text = F.col("document.text")
    found = sharded(docs, shards).select(
        F.col("document.doc_id").alias("doc_id"), (text_bytes(text) + HEADER).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), "shard", "slot", "old_shard", "moved")
    found = stored(found, "placed")
    blocks = transfers(found).select("old_shard", "shard", F.col("documents").alias("transfer_documents"),
                                     F.col("bytes").alias("transfer_bytes"), F.lit(True).alias("moved"))
    return found.join(F.broadcast(blocks), ["old_shard", "shard", "moved"], "left").select(  # bounded by the pairs of shards
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "old_shard", "moved", "transfer_documents", "transfer_bytes")
