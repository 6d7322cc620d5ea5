"""Near-duplicate classes by DartMinHash.

Signature. Every (shingle, weight strip) throws darts at its region: a Poisson process along the rank axis whose
rate is the strip's width, each dart with a hashed weight position, a hashed coordinate and an identity. A dart
counts if its weight position lies under the shingle's weight. The earliest counted dart of each of the ``K``
coordinates is kept. Two documents keep the same dart in a coordinate with a probability equal to their weighted
Jaccard similarity. Darts are only thrown up to the rank by which about K ln K have fallen on the whole
document, so a signature costs K ln K + size, not K x size; documents with a coordinate still empty throw on.

Classes. ``BANDS`` bands of ``ROWS`` coordinates deal the distinct texts to buckets (a pair of similarity 0.8 misses
every bucket once in 20 million times). In buckets of up to ``SMALL`` texts all pairs are candidates; in larger ones
every text is paired with three leaders of the bucket. Candidates whose signatures agree too rarely for the
threshold (five standard deviations) go; the others are checked exactly on their shingle sets. What leaders
cannot tell is settled exactly: texts of large buckets that hold several classes are joined on their rarest
shingles (two sets of similarity t must share one of their (1 - t) n + 1 rarest shingles, at places that leave room
for the overlap), and the pairs found are checked. No bucket is capped and no group is sent to one task; equal texts
are one node throughout. Links, labels and signatures stay in Spark tables.

Words are the lower-cased runs between white space; a text of fewer words than a shingle is one shingle.
Weights are 1 for each distinct shingle (``weighting="distinct"``, plain Jaccard) or its number of places
(``weighting="count"``).

Defined results: a null text is an empty text; texts without words are alike only if equal; rows that share
an id are one document, so their texts are one class; a row without an id gets a negative stand-in made of
its text, which the result shows as its id; repeated rows and ties are of one class; an empty table gives an empty result; extra columns
are ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stored
from .graph import components

SHINGLE = 5
K, ROWS = 128, 4
BANDS = K // ROWS
SMALL = 16
LEADERS = 3
SALTS = 16  # keys over which a crowded bucket is dealt out; results do not depend on it


def _mix(x):
    """A 64-bit finaliser on uint64 arrays."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(n: int, odd: int):
    """n times an odd constant, as uint64."""
    import numpy as np

    return np.uint64(n * odd & 0xFFFFFFFFFFFFFFFF)


def _unit(x):
    """Hashes as numbers in (0, 1]."""
    import numpy as np

    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (2.0 ** -53)


def shingles(words, ends):
    """Shingle hashes of a batch and the document of each: ``words`` are the word hashes of all documents one
    after the other (uint64), ``ends`` the offsets of the documents (from 0)."""
    import numpy as np

    sizes = np.diff(ends)
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    doc = np.repeat(np.arange(len(sizes)), counts)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + ends[:-1][doc]
    h = np.zeros(len(doc), np.uint64)
    for k in range(SHINGLE):
        at = start + k
        there = at < ends[1:][doc]
        w = np.where(there, words[np.minimum(at, max(len(words) - 1, 0))], np.uint64(0)) if len(words) else h
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w + np.uint64(k + 1))
    return h, doc


def signatures(h, doc, n_docs: int, weight=None, k: int = K, seed: int = 0):
    """Identities of the earliest darts, (n_docs, k) uint64, and whether a document has any element. ``h``: element
    hashes, ``doc``: their documents (ascending), ``weight``: their weights (default 1)."""
    import numpy as np

    best = np.full(n_docs * k, np.inf)
    out = np.zeros(n_docs * k, np.uint64)
    weight = np.ones(len(h)) if weight is None else np.asarray(weight, np.float64)
    total = np.bincount(doc, weight, n_docs)
    some = total > 0
    h = _mix(h ^ _mix(np.full(1, seed, np.uint64) + np.uint64(0x5851F42D4C957F2D)))
    reach = np.where(some, k * (math.log(k) + 2) / np.maximum(total, 1e-300), 0.0)
    open_doc = some.copy()
    while open_doc.any():
        use = np.flatnonzero(open_doc[doc])
        strip, low, width = 0, 0.0, 1.0
        live_strip = use
        while len(live_strip):
            live, rank, throw = live_strip, np.zeros(len(live_strip)), 0
            base = _mix(h[live] + _salt(strip, 0xD1342543DE82EF95))
            limit = reach[doc[live]]
            w = weight[live]
            while len(live):
                throw += 1
                u = _mix(base + _salt(throw, 0x9E3779B97F4A7C15))
                rank = rank - np.log(_unit(u)) / width
                stay = rank <= limit
                live, rank, base, limit, w, u = live[stay], rank[stay], base[stay], limit[stay], w[stay], u[stay]
                dart = _mix(u ^ np.uint64(0xA0761D6478BD642F))
                hit = low + width * _unit(_mix(dart + np.uint64(1))) <= w
                key = doc[live[hit]] * k + (dart[hit] % np.uint64(k)).astype(np.int64)
                got = rank[hit]
                np.minimum.at(best, key, got)
                won = got <= best[key]
                out[key[won]] = dart[hit][won]
            strip += 1
            low, width = low + width, max(1.0, low + width)
            live_strip = use[weight[use] > low]
        open_doc = some & (best.reshape(n_docs, k) == np.inf).any(1)
        reach = np.where(open_doc, 2 * reach, 0.0)
    return out.reshape(n_docs, k), some


def id_key(docs: DataFrame, id_col: str, text: Column) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), -1 - F.pmod(F.xxhash64(text), F.lit(1 << 62)))


def hashed_words(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(F.lower(text), r"\s+"), ""), lambda w: F.xxhash64(w))


def _arrays(column):
    """Flat uint64 values and offsets of a list column."""
    import numpy as np

    ends = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    return flat.astype(np.int64, copy=False).view(np.uint64), ends - ends[0]


def _lists(values, ends, kind):
    import numpy as np
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, kind))


def signature_table(rows: DataFrame, weighting: str) -> DataFrame:
    """``id``, ``fp`` (digest of the text), ``bands`` (a hash per band, null for a text without words) and ``sig``
    (a byte per coordinate), from rows (id, text)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                words, ends = _arrays(part.column(2))
                h, doc = shingles(words, ends)
                weight = None
                if weighting == "count":
                    order = np.lexsort((h, doc))
                    h, doc = h[order], doc[order]
                    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])][:len(h)])
                    weight = np.diff(np.r_[first, len(h)]).astype(np.float64)
                    h, doc = h[first], doc[first]
                sig, some = signatures(h, doc, part.num_rows, weight)
                band = np.zeros((part.num_rows, BANDS), np.uint64)
                for r in range(ROWS):
                    band = _mix(band * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS])
                low = (sig & np.uint64(0xFF)).astype(np.uint8)
                bands = _lists(band.view(np.int64).ravel(), np.arange(part.num_rows + 1) * BANDS, pa.int64())
                none = pa.array(~some)
                bands = pa.compute.if_else(none, pa.scalar(None, bands.type), bands)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), bands,
                     pa.array([low[i].tobytes() for i in range(part.num_rows)], pa.binary())],
                    names=["id", "fp", "bands", "sig"])

    hashed = rows.select("id", F.unhex(F.md5("text")).alias("fp"), hashed_words(F.col("text")).alias("w"))
    return map_arrow(hashed, run, "id bigint, fp binary, bands array<bigint>, sig binary")


def shingle_sets(rows: DataFrame) -> DataFrame:
    """``node`` and ``set`` (sorted distinct shingle hashes), from rows (node, text)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                h, doc = shingles(*_arrays(part.column(1)))
                h = h.view(np.int64)
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                first = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])][:len(h)]
                ends = np.r_[0, np.cumsum(np.bincount(doc[first], minlength=part.num_rows))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _lists(h[first], ends, pa.int64())], names=["node", "set"])

    hashed = rows.select("node", hashed_words(F.col("text")).alias("w"))
    return map_arrow(hashed, run, "node bigint, set array<bigint>")


def _agreeing(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose signatures agree as often as the threshold allows, less five deviations."""
    least = K * threshold - 5 * math.sqrt(K * threshold * (1 - threshold))
    sig = nodes.select("node", "sig")
    joined = (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("x")), "a")
              .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("y")), "b").select("a", "b", "x", "y"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, K) for k in (2, 3))
            same = (x == y).sum(1)
            keep = pa.array(same >= least)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(same, pa.int32()).filter(keep)],
                names=["a", "b", "agree"])

    return map_arrow(joined, run, "a bigint, b bigint, agree int")


def _checked(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose shingle sets have Jaccard similarity of at least the threshold."""
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
            .select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("n"))
            .filter(F.col("both") >= threshold * (F.col("n") - F.col("both"))).select("a", "b"))


def _candidates(buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a < b), and the crowded buckets (bucket, large, lead)."""
    salted = [F.min_by("node", F.xxhash64("node", F.lit(s))).alias(f"l{s}") for s in range(1, LEADERS)]
    crowded = (buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("l0"),
                                             F.max("node").alias("most"), *salted)
               .filter("l0 <> most")
               .select("bucket", (F.col("n") > SMALL).alias("large"),
                       F.array_distinct(F.array(*[f"l{s}" for s in range(LEADERS)])).alias("lead")))
    crowded = stored(crowded, "crowded")
    members = stored(buckets.join(crowded, "bucket").select("bucket", "node", "large", "lead"), "members")
    star = members.filter("large").select("node", F.explode("lead").alias("lead"))
    small = members.filter("not large").groupBy("bucket").agg(F.sort_array(F.collect_set("node")).alias("all"))  # <= SMALL
    pairs = small.select(F.explode(F.flatten(F.transform(
        "all", lambda x, i: F.transform(F.slice("all", i + 2, SMALL), lambda y: F.struct(x.alias("a"), y.alias("b")))
    ))).alias("p")).select("p.a", "p.b")
    candidates = (star.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b"))
                  .union(pairs).filter("a <> b").distinct())
    return candidates, members


def _rare_pairs(residue: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs of nodes of different labels that can reach the threshold, found on their rarest shingles.
    ``residue``: node, label, size (nodes of its label); pairs are probed from the smaller label."""
    tokens = sets.join(residue, "node").select(
        "node", "label", "size", F.xxhash64("set").alias("of"), F.size("set").alias("n"), F.explode("set").alias("t"))
    df = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # a shingle of one text alone can match nothing: it only holds a place before the shared ones
    own = Window.partitionBy("node", "of")
    ranked = (tokens.join(df, "t")
              .withColumn("place", F.row_number().over(own.orderBy("df", "t")) - 1
                          + F.col("n") - F.count(F.lit(1)).over(own))
              .filter(F.col("place") <= F.col("n") * (1 - threshold) + 1e-9)
              .select("node", "label", "size", "n", "t", "place"))
    ranked = stored(ranked, "rare")
    left = ranked.select(*[F.col(c).alias(f"x_{c}") for c in ranked.columns])
    right = ranked.select(*[F.col(c).alias(f"y_{c}") for c in ranked.columns])
    need = F.ceil((F.col("x_n") + F.col("y_n")) * (threshold / (1 + threshold)) - 1e-9)
    smaller = (F.col("x_size") < F.col("y_size")) | (
        (F.col("x_size") == F.col("y_size")) & (F.col("x_label") < F.col("y_label")))
    return (left.join(right, (F.col("x_t") == F.col("y_t")) & smaller
                      & (F.col("x_n") - F.col("x_place") >= need) & (F.col("y_n") - F.col("y_place") >= need))
            .select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = 0.8,
                    weighting: str = "distinct") -> DataFrame:
    """One row per input row: ``id_col``, ``class_id`` (smallest id of its class) and ``kept`` (one row of each
    class: the one of the smallest id whose text digest is smallest; of rows equal in both, all). The exact
    check is on distinct shingles."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(id_key(docs, id_col, text).alias("id"), text.alias("text"))
    sigs = stored(signature_table(rows, weighting), "signatures")
    nodes = stored(sigs.groupBy("fp").agg(F.min("id").alias("node"), F.first("bands").alias("bands"),
                                          F.first("sig").alias("sig")), "nodes")
    buckets = nodes.filter("bands is not null").select("node", F.posexplode("bands").alias("band", "hash")).select(
        "node", F.xxhash64("band", "hash").alias("bucket"))
    candidates, members = _candidates(buckets)
    likely = stored(_agreeing(candidates, nodes, threshold), "likely")

    # texts that an exact check needs: those of a likely pair or of a large bucket
    needed = stored(likely.select(F.col("a").alias("node")).union(likely.select("b"))
                    .union(members.filter("large").select("node")).distinct(), "needed")
    own = nodes.select(F.col("fp"), "node").join(needed, "node")
    texts = (rows.withColumn("fp", F.unhex(F.md5("text"))).withColumnRenamed("id", "node")
             .join(own, ["node", "fp"], "left_semi").dropDuplicates(["node", "fp"]).select("node", "text"))
    sets = stored(shingle_sets(texts), "sets")
    links = stored(_checked(likely.select("a", "b"), sets, threshold), "links")
    labels = components(links)

    # large buckets that hold several classes
    large = members.filter("large").select("bucket", "node")
    labelled = large.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    mixed = (labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .filter("low <> high").select("bucket", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    # a bucket may hold a third of all texts: each is dealt out over SALTS keys
    dealt = labelled.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    open_nodes = stored(dealt.join(mixed, ["bucket", "salt"]).select("node", "label").distinct(), "open")
    if not open_nodes.isEmpty():
        size = open_nodes.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
        residue = stored(open_nodes.join(size, "label").select("node", "label", "size"), "residue")
        rare = stored(_agreeing(_rare_pairs(residue, sets, threshold), nodes, threshold), "rare-likely")
        more = stored(_checked(rare.select("a", "b"), sets, threshold), "rare-links")
        if not more.isEmpty():
            labels = components(links.union(more))

    # a text's class, then the classes of rows that share an id
    of_text = (nodes.select("fp", "node").join(labels, "node", "left")
               .select("fp", F.coalesce("label", "node").alias("class_id")))
    out = sigs.select("id", "fp").join(of_text, "fp")
    first = out.groupBy("class_id").agg(F.min(F.struct("id", "fp")).alias("first"))
    return out.join(first, "class_id").select(
        F.col("id").alias(id_col), "class_id", F.col("fp"),
        (F.struct("id", "fp") == F.col("first")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = 0.8) -> DataFrame:
    """One document of each class, the input's columns. Of repeated rows (equal id and text) one stays."""
    classes = stored(near_duplicates(docs, id_col, text_col, threshold=threshold)
                     .select("class_id", "fp", "kept"), "classes")
    kept = classes.filter("kept")
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.withColumn("__class", id_key(docs, id_col, text)).withColumn("__fp", F.unhex(F.md5(text)))
    out = marked.join(kept.select(F.col("class_id").alias("__class"), F.col("fp").alias("__fp")),
                      ["__class", "__fp"], "left_semi")
    if not kept.groupBy("class_id").count().filter("count > 1").isEmpty():
        out = out.dropDuplicates(["__class", "__fp"])
    return out.drop("__class", "__fp").select(*docs.columns)


def class_rows(docs: DataFrame) -> DataFrame:
    """One row per document."""
    return near_duplicates(docs.select("doc_id", "text")).select("doc_id", "class_id", "kept")
