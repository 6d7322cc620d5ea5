"""Quality rules, line first: every line is judged by punctuation, navigation and boilerplate rules,
failing lines are removed, and a document that loses too much of its text is rejected.

Everything is a row-wise DataFrame expression: one scan, no shuffle, no Python. A document is never
split over tasks and no document needs another one, so hot sources and groups of copies cost no more
than their rows.

Defined results: a null text is an empty text (no lines, no words, ``base_failed``, not kept); repeated
rows each get their own result; an empty table gives an empty result; extra columns of the input are
ignored (the result has its own columns beside ``doc_id``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

# Fixed values of the word and symbol definitions.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# A line of prose ends in one of these.
TERMINAL = r"[.!?…:;。！？\"'»”’)\]]\s*$"
# Marks between the entries of a menu.
SEPARATORS = "|»›•·>"
# Marks that prose hardly ever carries more than once in a few words.
NOISE = "!#*$%&|<>»›•·=_~^{}@"
BOILERPLATE = (
    "all rights reserved", "cookie", "privacy policy", "terms of use", "terms of service",
    "enable javascript", "lorem ipsum", "sign in", "log in", "subscribe", "click here",
    "read more", "powered by", "back to top", "share this",
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES, -1), "")


def n_of(text: Column, marks: str) -> Column:
    """How many characters of ``marks`` the text has (one pass of a character class: ``translate``
    looks every character up in a map and costs several times as much)."""
    return F.regexp_count(text, F.lit("[" + "".join("\\" + m for m in marks) + "]"))


def without_space(text: Column) -> Column:
    for c in SPACE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of WINDOW words found twice or more in the text, the first finding
    included. Windows are compared by 64-bit hash; equal hashes meet by sorting, so a text made of
    repetition costs n log n."""
    n = F.size(words)

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twice = F.filter(s, lambda e, j: F.get(s, j - 1)["h"].eqNullSafe(e["h"])
                             | F.get(s, j + 1)["h"].eqNullSafe(e["h"]))
            return F.array_sort(F.transform(twice, lambda e: e["i"]))

        def total(at: Column) -> Column:
            steps = F.transform(at, lambda x, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(at, k + 1), x + WINDOW) - x))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            let(let(pairs, starts), total))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    return F.when(n < WINDOW, 0).otherwise(let(let(words, windows), covered)).cast("long")


def line_verdict(line: Column, n_words: Column, short: int, noise_share: float) -> Column:
    """'' for a line to keep, else the rule that it breaks."""
    low = F.lower(line)
    phrase = F.lit(False)
    for p in BOILERPLATE:
        phrase = phrase | low.contains(p)
    separators = n_of(line, SEPARATORS)
    return (F.when(n_words == 0, "")
            .when(let(separators, lambda k: (k >= 2) & (k * 5 >= n_words)), "navigation")
            .when((n_words <= 2 * short) & phrase, "boilerplate")
            .when(n_of(line, NOISE) >= n_words * noise_share, "punctuation")
            .when((n_words < short) & ~line.rlike(TERMINAL), "punctuation")
            .otherwise(""))


def clean_lines(docs: DataFrame, text_col: str = "text", *, max_loss: float = 0.3, short: int = 8,
                noise_share: float = 0.4) -> DataFrame:
    """The input's columns plus ``clean_text`` (the lines kept, joined by a line feed), ``n_lines``
    (lines with a word), ``n_removed_lines``, ``n_text_words``, ``n_removed_words``, ``failed_rules``
    (distinct rules broken, sorted) and ``line_kept`` (false if more than ``max_loss`` of the words went).

    A line breaks ``navigation`` if menu separators stand between at most five words each,
    ``boilerplate`` if it is short and holds a stock phrase, ``punctuation`` if it carries noise marks on
    ``noise_share`` of its words or is short and ends without a sentence mark. Columns of the input with one of the
    new names are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    judged = F.transform(F.split(text, "\n", -1), lambda s: let(F.size(words_of(s)), lambda n: F.struct(
        s.alias("line"), n.alias("n"), line_verdict(s, n, short, noise_share).alias("rule"))))

    def summary(lines: Column) -> Column:
        kept = F.filter(lines, lambda x: x["rule"] == "")
        gone = F.filter(lines, lambda x: x["rule"] != "")

        def total(part: Column) -> Column:
            return F.aggregate(part, F.lit(0), lambda a, x: a + x["n"])
        return F.struct(
            F.array_join(F.transform(kept, lambda x: x["line"]), "\n").alias("clean_text"),
            F.size(F.filter(lines, lambda x: x["n"] > 0)).cast("long").alias("n_lines"),
            F.size(gone).cast("long").alias("n_removed_lines"),
            total(lines).cast("long").alias("n_text_words"),
            total(gone).cast("long").alias("n_removed_words"),
            F.array_join(F.array_sort(F.array_distinct(F.transform(gone, lambda x: x["rule"]))), ",")
            .alias("failed_rules"))

    new = ("clean_text", "n_lines", "n_removed_lines", "n_text_words", "n_removed_words", "failed_rules")
    out = docs.withColumn("__lines", F.explode(F.array(let(judged, summary))))
    for name in new:
        out = out.withColumn(name, F.col(f"__lines.{name}"))
    return out.drop("__lines").withColumn(
        "line_kept", F.col("n_removed_words") <= F.col("n_text_words") * F.lit(max_loss))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: the counts, the base verdict and the line-first verdict."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    cleaned = clean_lines(rows)
    body = F.filter(F.split(F.col("text"), "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    counted = cleaned.select(
        "doc_id", "n_lines", "n_removed_lines", "n_removed_words", "failed_rules", "line_kept",
        F.col("n_text_words").alias("n_words"),
        F.char_length(without_space(F.col("text"))).cast("long").alias("word_chars"),
        n_of(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        let(body, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
        repeated_words(words_of(F.col("text"))).alias("n_repeat_words"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("line_kept")).alias("kept"),
        "n_lines", "n_removed_lines", "n_removed_words", "failed_rules")
