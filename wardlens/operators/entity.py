"""Hospital entity resolution.

The anchor of a name is its rarest token over the whole table (every occurrence counts), the
first one on ties, 'unknown' when the name has no usable token. The canonical name of an anchor
group is its most frequent raw (comma-stripped) name, the smallest on ties.

Scale plan. The work runs on *distinct names with a row weight*, never on rows:
1. ``groupBy(name).count()``: partial aggregation per task, so a name holding a third of all
   rows costs one row per task before the shuffle;
2. tokens of each distinct name (``posexplode``) -> weighted token counts (partial aggregation
   again, so a hot token is no problem);
3. anchor per name = ``min_by(token, (count, position))`` and canonical per anchor =
   ``min((-weight, name))``: both are plain aggregates with map-side combine, so a huge anchor
   group is never buffered in one task (pandas' group ``mode`` would be);
4. the rows are joined once to the name -> (anchor, canonical) map. AQE broadcasts the map
   when its runtime size is small and otherwise splits skewed name partitions.
Nothing pairs names with each other: no name x name matrix, no candidate pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.functions.text import ANCHOR_STOPWORDS, anchor_tokens, strip_trailing, token_signature
from wardlens.session import cut_lineage


def name_weights(df: DataFrame, col: str = "hospital", strip: str | None = ",") -> DataFrame:
    """Distinct (comma-stripped) names with the number of rows carrying each: entity_name, name_rows."""
    name = strip_trailing(col, strip) if strip else F.col(col)
    return df.groupBy(name.alias("entity_name")).agg(F.count(F.lit(1)).alias("name_rows"))


def anchor_map(names: DataFrame, stopwords=ANCHOR_STOPWORDS, min_len: int = 3,
               unknown: str = "unknown") -> DataFrame:
    """entity_name, name_rows -> entity_name, name_rows, anchor (rarest token; NULL name -> NULL)."""
    toks = names.select("entity_name", "name_rows",
                        F.posexplode(anchor_tokens("entity_name", stopwords, min_len)).alias("pos", "token"))
    counts = toks.groupBy("token").agg(F.sum("name_rows").alias("token_count"))
    best = (toks.join(counts, "token")
                .groupBy("entity_name")
                .agg(F.min_by("token", F.struct("token_count", "pos")).alias("anchor")))
    return (names.join(best, "entity_name", "left")
                 .withColumn("anchor", F.when(F.col("entity_name").isNotNull(),
                                              F.coalesce("anchor", F.lit(unknown)))))


def first_token_anchor_map(names: DataFrame, stopwords=ANCHOR_STOPWORDS, min_len: int = 4) -> DataFrame:
    """C10 strategy: the first token of at least ``min_len`` letters, else the lowercased name."""
    first = F.get(anchor_tokens("entity_name", stopwords, min_len), 0)
    return names.withColumn("anchor", F.coalesce(first, F.lower("entity_name")))


def canonical_map(anchors: DataFrame) -> DataFrame:
    """anchor -> canonical: the name with most rows in the group, smallest name on ties."""
    best = F.min(F.struct((-F.col("name_rows")).alias("neg_rows"), F.col("entity_name").alias("name")))
    return (anchors.filter(F.col("anchor").isNotNull())
                   .groupBy("anchor").agg(best.alias("b"))
                   .select("anchor", F.col("b.name").alias("canonical")))


def entity_map(df: DataFrame, col: str = "hospital", strategy: str = "rarest", stopwords=ANCHOR_STOPWORDS,
               min_len: int | None = None, strip: str | None = ",", checkpoint: bool = True) -> DataFrame:
    """entity_name -> (anchor, canonical) over the distinct names of ``df[col]``.

    The distinct-name table is read several times (token counts, anchors, canonical names), so
    it is written once as a reliable checkpoint: the big input is scanned once for the map."""
    names = name_weights(df, col, strip)
    if checkpoint:
        names = cut_lineage(names)
    if strategy == "rarest":
        anchors = anchor_map(names, stopwords, 3 if min_len is None else min_len)
    elif strategy == "first":
        anchors = first_token_anchor_map(names, stopwords, 4 if min_len is None else min_len)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    out = (anchors.join(canonical_map(anchors), "anchor", "left")
                  .withColumn("group_id", group_id(F.col("anchor"))))
    return cut_lineage(out) if checkpoint else out


def group_id(anchor) -> "F.Column":
    """A stable group number per anchor (64-bit hash): the same on every run and cluster,
    with no global numbering pass (first-appearance numbering would need one ordered task)."""
    return F.when(anchor.isNotNull(), F.xxhash64(anchor))


def on_name(df: DataFrame, names: DataFrame, col: str) -> DataFrame:
    """Rows with the columns of their name. Rows without a name match nothing; each gets a key of its own,
    so a third of the rows being nameless does not end in one partition."""
    spread = F.concat(F.lit("\x00"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string"))
    keyed = df.withColumn("_name", F.coalesce(F.col(col), spread))
    return keyed.join(names.withColumnRenamed("entity_name", "_name"), "_name", "left").drop("_name")


def stripped(df: DataFrame, col: str, strip: str | None) -> DataFrame:
    return df.withColumn(col, strip_trailing(col, strip) if strip else F.col(col))


def resolve_entities(df: DataFrame, col: str = "hospital", strategy: str = "rarest", stopwords=ANCHOR_STOPWORDS,
                     min_len: int | None = None, strip: str | None = ",", anchor_col: str | None = None,
                     canonical_col: str | None = None, on_unknown: str = "label") -> DataFrame:
    """Rows of ``df`` with ``col`` comma-stripped and ``<col>_anchor`` / ``<col>_canonical`` added. Names without
    a usable token share the anchor 'unknown' (``on_unknown="label"``) and its canonical name, or keep
    their own name as canonical (``"own_name"``)."""
    if on_unknown not in ("label", "own_name"):
        raise ValueError(f"unknown on_unknown {on_unknown!r}")
    m = entity_map(df, col, strategy, stopwords, min_len, strip)
    canonical = F.col("canonical")
    if on_unknown == "own_name":
        canonical = F.when(F.col("anchor") == "unknown", F.col("entity_name")).otherwise(canonical)
    m = m.select("entity_name", F.col("anchor").alias(anchor_col or f"{col}_anchor"),
                 canonical.alias(canonical_col or f"{col}_canonical")).filter(F.col("entity_name").isNotNull())
    return on_name(stripped(df, col, strip), m, col)


def anchor_entity(df: DataFrame, col: str = "hospital", stopwords=ANCHOR_STOPWORDS, min_len: int = 3,
                  strip: str | None = ",") -> DataFrame:
    """Rows with the rarest-token anchor (no canonical names are computed)."""
    names = cut_lineage(name_weights(df, col, strip))
    m = anchor_map(names, stopwords, min_len).filter(F.col("entity_name").isNotNull()).select(
        "entity_name", F.col("anchor").alias(f"{col}_anchor"))
    return on_name(stripped(df, col, strip), m, col)


def first_long_token_entity(df: DataFrame, col: str = "hospital", stopwords=ANCHOR_STOPWORDS, min_len: int = 4,
                            strip: str | None = ",") -> DataFrame:
    """The first token of at least ``min_len`` letters, else the lowercased name: a row expression."""
    return stripped(df, col, strip).withColumn(
        f"{col}_anchor", F.coalesce(F.get(anchor_tokens(col, stopwords, min_len), 0), F.lower(col)))


def canonical_entity(df: DataFrame, col: str = "hospital", drop_source: bool = False, **kw) -> DataFrame:
    """Rows with anchor and canonical name; ``drop_source`` mirrors the cleaned file, which
    keeps only the canonical column."""
    out = resolve_entities(df, col, **kw)
    return out.drop(col, f"{col}_anchor") if drop_source else out


def with_token_signature(df: DataFrame, col: str = "hospital", out_col: str | None = None) -> DataFrame:
    """Sorted distinct tokens, a helper the cleaner computes and then drops."""
    return df.withColumn(out_col or f"{col}_clean", token_signature(col))


def entity_audit(df: DataFrame, col: str = "hospital", sample: int = 5, groups: int | None = None,
                 **kw) -> DataFrame:
    """Per anchor group, its rows, its distinct names and the ``sample`` smallest names;
    ``groups`` keeps only the first groups by anchor (the printed audit shows 15).

    The sample is a row_number <= n filter over distinct names; Catalyst turns it into a
    WindowGroupLimit before the shuffle, so a group with millions of names ships n per task."""
    m = entity_map(df, col, **kw).filter(F.col("anchor").isNotNull())
    w = Window.partitionBy("anchor").orderBy("entity_name")
    samples = (m.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= sample)
                .groupBy("anchor").agg(F.array_join(F.array_sort(F.collect_list("entity_name")), " | ")
                                       .alias("sample_names")))
    sizes = m.groupBy("anchor").agg(F.sum("name_rows").alias("group_rows"),
                                    F.count(F.lit(1)).alias("distinct_names"))
    out = sizes.join(samples, "anchor")
    return out.orderBy("anchor").limit(groups) if groups else out


def entity_audit_summary(df: DataFrame, col: str = "hospital", **kw) -> DataFrame:
    """C8 totals: number of anchor groups, rows, rows per group (1 dp)."""
    from wardlens.functions.numeric import exact_round
    m = entity_map(df, col, **kw)
    groups = F.count_distinct("anchor")
    rows = F.sum("name_rows")
    return m.agg(groups.alias("anchor_groups"), rows.alias("total_rows"),
                 exact_round(rows, groups, 1).alias("avg_rows_per_group"))
