"""Source divergence audit: how far the term shares of each source lie from those of every other source of its language,
and which terms set a source apart from its language.

Per language the kept terms are those in at least ``MIN_DOCS`` of its documents. A group (a source, or the whole
language) gives each kept term the share p = 1 + floor(UNIT * (count + 1) / (N + V)): N occurrences of kept terms in the
group, V kept terms. The divergence of a share p from a share q is floor((p - q)^2 / q); all arithmetic is in integers.

Method. The sum of a pair of sources over all terms is not taken term by term. A term that neither source has costs
the same for all such terms; a term that one has depends on its count there alone (a histogram of counts per source); a
term that both have needs a correction that depends on the two counts. For the corrections each term is a row of
its nonzero counts, (source, count) in a fixed order of the sources, the one with most terms first. Equal rows become one
with a multiplicity, and the rows are inserted in a frequent-pattern tree: a node stands for all terms that
begin with the same counts, and each combination of a node and an ancestor is a pair of counts that as many terms share
as pass the node. Rows are dealt out in order, so a task walks its part of the tree with one open path (nothing
of the tree is stored), and combinations that several tasks meet are summed by Spark.

No task holds a group: terms are counted per task before they are shuffled, a term's row is as long as its language
has sources, and windows for the term ranks keep ``TOP_TERMS`` per group and task before the shuffle.

Defined results: null text, lang and source are ''; a language without kept terms has pair rows of value 0 and no term
rows; every row is a document of its own; ties are ranked by the item's UTF-8 bytes; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, parts, stored

MIN_DOCS = 3
TOP_TERMS = 200
UNIT = 1_000_000_000
HELD = 300_000  # counts that a task holds before it hands them on; results do not depend on it
# Letters A-Z and a-z, and all beyond ASCII (the bytes of a character beyond ASCII are all above 7F).
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``docs`` (documents that hold it), stored; one row
    without a term for each group that occurs."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n: dict[tuple, Counter] = {}
        docs: dict[tuple, Counter] = {}

        def rows():
            for (lang, source), counts in n.items():
                held = docs[lang, source]
                size = len(counts) + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                    pa.array([*(t.decode() for t in counts), None], pa.string()),
                    pa.array([*counts.values(), 0], pa.int64()), pa.array([*(held[t] for t in counts), 0], pa.int64()),
                ], names=["lang", "source", "term", "n", "docs"])

        for part in parts(batches):
            langs, texts, sources = (part.column(k).to_pylist() for k in range(3))
            for lang, text, source in zip(langs, texts, sources, strict=True):
                terms = _TERM.findall(text.encode().lower())
                n.setdefault((lang, source), Counter()).update(terms)
                docs.setdefault((lang, source), Counter()).update(set(terms))
            if sum(map(len, n.values())) > HELD:
                yield from rows()
                n, docs = {}, {}
        yield from rows()

    def text(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = docs.select(text(lang_col).alias("lang"), text(text_col).alias("text"), text(source_col).alias("source"))
    counted = map_arrow(rows, run, "lang string, source string, term string, n bigint, docs bigint")
    return stored(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
                  "audit-counts")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """p of a term: 1 + floor(UNIT * (count + 1) / (total + terms))."""
    top = (count.cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")) * F.lit(UNIT).cast("decimal(10,0)")
    low = F.greatest(total.cast("decimal(19,0)") + terms.cast("decimal(18,0)"), F.lit(1).cast("decimal(20,0)"))
    return F.call_function("div", top, low) + 1


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); p and q are at most UNIT + 1, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), q)


def term_rows(counts: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """The groups (``lang``, ``source``, ``rank`` in the order of the tree, ``total``, ``lang_total``, ``terms``) and
    the kept terms (``lang``, ``term``, ``n`` and ``path``: its nonzero counts as (rank, n), in that order), stored."""
    order = Window.partitionBy("lang").orderBy(F.desc("held"), "source")
    groups = (counts.groupBy("lang", "source").agg(F.count("term").alias("held"))
              .select("lang", "source", (F.row_number().over(order) - 1).alias("rank")))
    kept = stored(counts.filter("term is not null").join(groups, ["lang", "source"]).groupBy("lang", "term")
                  .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"),
                       F.array_sort(F.collect_list(F.struct("rank", "n"))).alias("path"))
                  .filter(F.col("docs") >= min_docs).drop("docs"), "audit-terms")
    totals = kept.select("lang", F.inline("path")).groupBy("lang", "rank").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    groups = stored(groups.join(totals, ["lang", "rank"], "left").join(langs, "lang", "left")
                    .na.fill(0, ["total", "lang_total", "terms"]), "audit-groups")
    return groups, kept


def shared_pairs(kept: DataFrame) -> DataFrame:
    """By walking the tree of the terms' rows: ``lang``, ``a``, ``n_a``, ``b``, ``n_b`` (two sources by rank, a above b
    in the tree, with a count of each) and ``times``, the number of terms that have both counts."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums: Counter = Counter()
        path: list[list[int]] = []  # open nodes: rank, count, terms that pass
        lang = None

        def close(depth: int) -> None:
            while len(path) > depth:
                b, n_b, times = path.pop()
                for a, n_a, _ in path:
                    sums[lang, a, n_a, b, n_b] += times
                if path:
                    path[-1][2] += times

        def rows():
            if sums:
                columns = [*zip(*sums, strict=True), sums.values()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)
                sums.clear()

        names = ["lang", "a", "n_a", "b", "n_b", "times"]
        types = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        for batch in batches:
            for of, ranks, counts, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != lang:
                    close(0)
                    lang = of
                depth, most = 0, min(len(path), len(ranks))
                while depth < most and path[depth][0] == ranks[depth] and path[depth][1] == counts[depth]:
                    depth += 1
                close(depth)
                path.extend([r, c, 0] for r, c in zip(ranks[depth:], counts[depth:], strict=True))
                path[-1][2] += times
                if len(sums) > HELD:
                    yield from rows()
        close(0)
        yield from rows()

    # equal rows once, with their number; then in order, so that neighbours share the beginnings of their paths
    ordered = (kept.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
               .repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
               .select("lang", F.col("path.rank").alias("ranks"), F.col("path.n").alias("counts"), "times"))
    met = map_arrow(ordered, run, "lang string, a int, n_a bigint, b int, n_b bigint, times bigint")
    return met.groupBy("lang", "a", "n_a", "b", "n_b").agg(F.sum("times").alias("times"))


def _side(groups: DataFrame, mark: str) -> DataFrame:
    """The groups as one side of a pair: rank, total and the share of a term that the group lacks."""
    return groups.select("lang", F.col("rank").alias(mark), F.col("total").alias(f"total_{mark}"), F.col("terms").alias(f"terms_{mark}"),
                         _share(F.lit(0), F.col("total"), F.col("terms")).alias(f"none_{mark}"))


def pair_divergence(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang``, ``a``, ``b`` (ranks of two sources) and ``value``: the divergence of a from b over all kept terms."""
    left, right = _side(groups, "a"), _side(groups, "b")
    none_a, none_b = F.col("none_a"), F.col("none_b")
    both = left.join(right, "lang").filter("a <> b")
    exact = "decimal(38,0)"
    # terms that neither has
    base = both.select("lang", "a", "b", (F.col("terms_a").cast("decimal(18,0)") * _gap(none_a, none_b)).cast(exact).alias("value"))
    # terms that one has, as if the other had not
    counts = kept.select("lang", F.inline("path")).groupBy("lang", "rank", "n").agg(F.count(F.lit(1)).alias("times"))
    one = counts.select("lang", F.col("rank").alias("a"), "n", "times").join(left, ["lang", "a"])
    one = one.withColumn("p", _share(F.col("n"), F.col("total_a"), F.col("terms_a"))).join(right, "lang").filter("a <> b")
    times = F.col("times").cast("decimal(18,0)")
    single = one.select("lang", "a", "b", (times * (_gap(F.col("p"), none_b) - _gap(none_a, none_b))).cast(exact).alias("there"),
                        (times * (_gap(none_b, F.col("p")) - _gap(none_b, none_a))).cast(exact).alias("back"))
    # terms that both have: what is left of them
    met = shared_pairs(kept).join(left, ["lang", "a"]).join(right, ["lang", "b"])
    met = (met.withColumn("p", _share(F.col("n_a"), F.col("total_a"), F.col("terms_a")))
           .withColumn("q", _share(F.col("n_b"), F.col("total_b"), F.col("terms_b"))))
    p, q = F.col("p"), F.col("q")

    def rest(x, y, none_x, none_y):
        return (times * (_gap(x, y) - _gap(x, none_y) - _gap(none_x, y) + _gap(none_x, none_y))).cast(exact)

    double = met.select("lang", "a", "b", rest(p, q, none_a, none_b).alias("there"), rest(q, p, none_b, none_a).alias("back"))
    parts = single.groupBy("lang", "a", "b").agg(F.sum("there").alias("there"), F.sum("back").alias("back")).unionByName(
        double.groupBy("lang", "a", "b").agg(F.sum("there").alias("there"), F.sum("back").alias("back")))
    parts = parts.select("lang", F.inline(F.array(
        F.struct(F.col("a"), F.col("b"), F.col("there").alias("value")),
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("back").alias("value")))))
    return base.unionByName(parts).groupBy("lang", "a", "b").agg(F.sum("value").cast("bigint").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``. Part ``pair``: the divergence of the source from each
    other source of its language. Part ``term``: the ``top`` kept terms that the source has with a larger share than
    its language, by their divergence from it."""
    groups, kept = term_rows(term_counts(docs, text_col, lang_col, source_col), min_docs)
    names = groups.select("lang", "rank", "source")
    pairs = (pair_divergence(groups, kept).join(names.withColumnRenamed("rank", "a"), ["lang", "a"])
             .join(names.withColumnsRenamed({"rank": "b", "source": "item"}), ["lang", "b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    terms = (kept.select("lang", "term", F.col("n").alias("lang_n"), F.inline("path")).join(groups, ["lang", "rank"])
             .withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))
             .withColumn("q", _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))).filter("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     _gap(F.col("p"), F.col("q")).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (pairs.withColumn("rank", F.row_number().over(order))
            .unionByName(terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)))
