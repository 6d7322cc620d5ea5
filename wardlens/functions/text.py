"""Name and token functions, all JVM-side: no Python UDF.

Two hospital-name rules exist and disagree by design (trap T9/T10):
* the warehouse rule keeps letters, splits on space and takes the first token that is not a
  case-sensitive stopword;
* the anchor rule lowercases, keeps letters and blanks, splits on whitespace and keeps tokens
  of at least ``min_len`` characters that are not in a lowercase stopword set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The warehouse cleaner's case-sensitive stopwords (the empty string included).
FIRST_TOKEN_STOPWORDS = ("and", "And", "Ltd", "Inc", "LLC", "PLC", "Sons", "Group", "")

# The anchor cleaner's lowercase stopwords.
ANCHOR_STOPWORDS = (
    "and", "ltd", "inc", "llc", "plc", "sons", "group",
    "the", "of", "a", "an", "co", "corp", "company",
    "associates", "partners", "services",
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Fixed value: the characters after which the warehouse's INITCAP starts a new word.
INITCAP_BREAKS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""


def _cased_runs(col, run: str) -> Column:
    """The text cut into alternating runs of ``run`` characters and others, each run Upper + lower (a run of
    breaks has no case)."""
    runs = F.regexp_extract_all(_c(col), F.lit(rf"([{run}]+|[^{run}]+)"), 1)
    cased = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30))))
    return F.when(_c(col).isNotNull(), F.array_join(cased, ""))


def initcap_name(col) -> Column:
    """The warehouse's INITCAP: a word starts after white space or punctuation ("o'neil-SMITH" -> "O'neil-Smith";
    Spark's initcap, which knows blanks only, gives "O'neil-smith"). A blank behind a stop mark after every break
    lets the built-in do the casing; a text that itself holds the stop mark is cased run by run."""
    stop = "\x01 "
    spaced = F.regexp_replace(_c(col), f"([{INITCAP_BREAKS}])", f"$1{stop}")
    return F.when(_c(col).contains(stop[0]), _cased_runs(col, INITCAP_BREAKS)).otherwise(
        F.replace(F.initcap(spaced), F.lit(stop), F.lit("")))


def title_case(col) -> Column:
    """Python ``str.title``: upper-case a letter that follows a non-letter, lower-case the rest
    ("o'neil-SMITH" -> "O'Neil-Smith")."""
    return _cased_runs(col, r"\p{L}")


def letters_only(col, pattern: str = "[^A-Za-z]+") -> Column:
    """REGEXP_REPLACE(col, '[^A-Za-z]+', ' ')."""
    return F.regexp_replace(_c(col), pattern, " ")


def strip_trailing(col, chars: str = ",") -> Column:
    """``str.rstrip(chars)``: remove every trailing occurrence of the given characters."""
    import re
    return F.regexp_replace(_c(col), "[" + re.escape(chars) + "]+$", "")


def first_token(col, stopwords=FIRST_TOKEN_STOPWORDS) -> Column:
    """Warehouse entity rule: first letter run (``[A-Za-z]+``) that is not one of ``stopwords``.

    Same result as replacing non-letters by a space, splitting and filtering the array, but one
    regex pass per row: a token start (string start or a non-letter before it), a lookahead that
    rejects a token equal to a stopword, then the whole letter run. NULL when no token is left
    or the input is NULL."""
    import re
    words = [re.escape(w) for w in stopwords if w]
    reject = f"(?!(?:{'|'.join(words)})(?![A-Za-z]))" if words else ""
    pattern = f"(?:^|[^A-Za-z]){reject}([A-Za-z]+)"
    return F.nullif(F.regexp_extract(_c(col), pattern, 1), F.lit(""))


def anchor_tokens(col, stopwords=ANCHOR_STOPWORDS, min_len: int = 3) -> Column:
    """Anchor-rule tokens: lowercase, non-letters to blanks, whitespace split, length and stopword filter.

    NULL input gives NULL (not an empty array), so a missing name stays missing.
    """
    low = F.regexp_replace(F.lower(_c(col)), r"[^a-z\s]", " ")
    toks = F.split(low, r"\s+")
    return F.filter(toks, lambda t: (F.length(t) >= max(min_len, 1)) & ~t.isin(list(stopwords)))


def token_signature(col, stopwords=ANCHOR_STOPWORDS, min_len: int = 3) -> Column:
    """Sorted distinct anchor tokens joined by one space."""
    return F.array_join(F.array_sort(F.array_distinct(anchor_tokens(col, stopwords, min_len))), " ")
