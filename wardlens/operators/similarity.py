"""Similarity grouping of names: TF-IDF cosine without a name x name matrix.

A name is a sparse vector: per token its number of occurrences times the token's inverse document frequency,
``round(1000 * (ln((1 + N) / (1 + df)) + 1))`` over the N distinct names. Weights are integers and the
threshold is a fraction of 1000, so ``cosine >= threshold`` is an exact comparison of whole numbers.

Prefix-filtered join. Let the tokens of each name stand in one global order, the rarest first. If the rarest
token that two names share stands at place i of a name, their product is at most |the name from i on| times the
other's length; so a name needs to be found only through tokens from which on it still holds the threshold's share
of its length. Names with equal tokens are one vector. Each pair is met once, at its rarest common token, and
verified by its exact product; no pair of a similarity of the threshold or more is lost.

Scale. Document frequencies, vectors and links are aggregates with map-side combine. A token that very many vectors
are found through is dealt out as a grid: its vectors are cut into k salts, and each cell (i, j) joins salt i
with salt j, so a task gets two pieces of about ``split`` vectors, never the whole token. Groups are the components of the
links (``components.min_labels``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.operators.components import min_labels
from wardlens.operators.entity import name_weights, on_name, stripped
from wardlens.session import cut_lineage

SPLIT = 5000  # vectors of one token in one cell of the grid
UNIT = 1000  # idf weights and thresholds are counted in thousandths


def words(col) -> Column:
    """Lower-case runs of letters and digits."""
    low = F.regexp_replace(F.lower(F.col(col) if isinstance(col, str) else col), "[^a-z0-9]+", " ")
    return F.filter(F.split(low, " "), lambda t: t != "")


def ngrams(n: int) -> Callable[[Column], Column]:
    """Character n-grams of the lower-cased words, joined and enclosed by single blanks; they also meet misspelt
    names. A name of blanks alone has none."""
    def cut(col) -> Column:
        text = F.array_join(words(col), " ")
        padded = F.concat(F.lit(" "), text, F.lit(" "))
        at = F.sequence(F.lit(1), F.greatest(F.char_length(padded) - n + 1, F.lit(1)))
        return F.when(text == "", F.array().cast("array<string>")).when(
            text.isNotNull(), F.transform(at, lambda i: F.substring(padded, i, F.lit(n))))
    return cut


def _exact(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(19,0)")


def name_vectors(names: DataFrame) -> DataFrame:
    """``names`` (entity_name, tokens) -> one row per distinct bag of tokens: ``rep`` (its smallest name), ``bag``,
    ``n_names``, ``items`` (df, token, weight; the rarest first) and ``norm2`` (the squared length)."""
    bags = (names.filter(F.size("tokens") > 0).groupBy(F.array_sort("tokens").alias("bag"))
            .agg(F.min("entity_name").alias("rep"), F.count(F.lit(1)).alias("n_names")))
    total = names.filter("entity_name is not null").count()
    seen = bags.select("n_names", F.explode(F.array_distinct("bag")).alias("token")).groupBy("token").agg(F.sum("n_names").alias("df"))
    idf = F.round(UNIT * (F.log(F.lit(1.0 + total) / (1 + F.col("df"))) + 1)).cast("bigint")
    entries = (bags.select("rep", F.explode("bag").alias("token")).groupBy("rep", "token").agg(F.count(F.lit(1)).alias("times"))
               .join(seen.withColumn("idf", idf), "token"))
    items = entries.groupBy("rep").agg(
        F.array_sort(F.collect_list(F.struct("df", "token", (F.col("times") * F.col("idf")).alias("weight")))).alias("items"))
    squares = F.aggregate("items", F.lit(0).cast("bigint"), lambda n, x: n + x["weight"] * x["weight"])
    return bags.join(items, "rep").withColumn("norm2", squares)


def _postings(vectors: DataFrame, threshold: int) -> DataFrame:
    """The tokens each vector is found through, with the squared length of the vector from that token on."""
    rest = F.aggregate(F.slice("items", F.col("pos") + 1, F.size("items")), F.lit(0).cast("bigint"),
                       lambda n, x: n + x["weight"] * x["weight"])
    return (vectors.select("rep", "norm2", "items", F.posexplode("items.token").alias("pos", "token"))
            .withColumn("rest2", rest).drop("pos")
            .filter(_exact("rest2") * (UNIT * UNIT) >= _exact("norm2") * (threshold * threshold)))


def similar_links(vectors: DataFrame, threshold: float = 0.8, split: int = SPLIT) -> DataFrame:
    """``a`` < ``b`` (representatives of two vectors) and ``product``, for all pairs of at least the threshold."""
    t = round(threshold * UNIT)
    if not 0 < t <= UNIT:
        raise ValueError("threshold must be above 0 and at most 1")
    postings = _postings(vectors, t)
    cells = postings.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / split).cast("int").alias("k"))
    placed = postings.join(cells, "token").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    left = placed.select("token", F.col("own").alias("i"), every.alias("j"), F.col("rep").alias("a"), F.col("items").alias("items_a"),
                         F.col("norm2").alias("norm_a"), F.col("rest2").alias("rest_a"))
    right = placed.select("token", every.alias("i"), F.col("own").alias("j"), F.col("rep").alias("b"), F.col("items").alias("items_b"),
                          F.col("norm2").alias("norm_b"), F.col("rest2").alias("rest_b"))
    need = _exact("norm_a") * _exact("norm_b") * (t * t)
    met = left.join(right, ["token", "i", "j"]).filter("a < b").filter(_exact("rest_a") * _exact("rest_b") * (UNIT * UNIT) >= need)
    # at the rarest common token only, so each pair once
    met = met.filter(F.array_intersect("items_a.token", "items_b.token")[0] == F.col("token"))
    other = F.map_from_arrays("items_b.token", "items_b.weight")
    product = F.aggregate("items_a", F.lit(0).cast("bigint"),
                          lambda n, x: n + x["weight"] * F.coalesce(F.try_element_at(other, x["token"]), F.lit(0)))
    met = met.withColumn("product", product)
    return met.filter(_exact("product") * _exact("product") * (UNIT * UNIT) >= need).select("a", "b", "product")


def similar_entities(df: DataFrame, col: str = "hospital", threshold: float = 0.8, tokens: Callable[[Column], Column] = words,
                     strip: str | None = ",", split: int = SPLIT) -> DataFrame:
    """Per distinct (comma-stripped) name: ``entity_name``, ``name_rows``, ``similar_group`` (the smallest name of its
    group) and ``n_links`` (other names of at least the threshold's similarity). A name without tokens is a group of its own
    with no links; a NULL name has no group."""
    names = cut_lineage(name_weights(df, col, strip).withColumn("tokens", tokens(F.col("entity_name"))))
    vectors = cut_lineage(name_vectors(names))
    links = cut_lineage(similar_links(vectors, threshold, split))
    sizes = vectors.select(F.col("rep").alias("b"), "n_names")
    around = (links.select("a", "b").union(links.select("b", "a")).join(sizes, "b")
              .groupBy(F.col("a").alias("rep")).agg(F.sum("n_names").alias("around")))
    groups = min_labels(links).select(F.col("node").alias("rep"), "label")
    of_bag = (vectors.select("rep", "bag", "n_names").join(around, "rep", "left").join(groups, "rep", "left")
              .select("bag", F.coalesce("label", "rep").alias("label"),
                      (F.coalesce("around", F.lit(0)) + F.col("n_names") - 1).alias("n_links")))
    return (names.withColumn("bag", F.array_sort("tokens")).join(of_bag, "bag", "left")
            .select("entity_name", "name_rows", F.coalesce("label", "entity_name").alias("similar_group"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def resolve_similar(df: DataFrame, col: str = "hospital", threshold: float = 0.8, tokens: Callable[[Column], Column] = words,
                    strip: str | None = ",", split: int = SPLIT) -> DataFrame:
    """Rows of ``df`` with ``col`` comma-stripped and ``<col>_similar``, the smallest name of its group."""
    groups = similar_entities(df, col, threshold, tokens, strip, split).filter("entity_name is not null")
    return on_name(stripped(df, col, strip), groups.select("entity_name", F.col("similar_group").alias(f"{col}_similar")), col)
