"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The library reads a text at one go, and its pattern engine fails on very long runs of white space. So a text is
first cut at places where the pattern's matches end whatever stands around them:

* before a blank or line feed that follows a printable ASCII character: no match holds white space after other
  characters, and nothing looks back;
* around a long run of white space. Of a run that other text follows, the pattern takes all but the last
  character as one match, and the last one stands with what follows; a run at the end of a text is one match.

Short texts are not cut. The pieces are encoded one after the other, the long runs by the same ranks as the one match
that they are, so the ids are those of the whole text, and no text is too long. Each row depends on itself alone;
nothing is shuffled, and a lost task is run again from its rows.

``encode`` packs the ids as little-endian unsigned 32-bit integers (the form token files have), ``decode`` turns
packed ids back into raw bytes: a token need not be valid UTF-8, so bytes are joined before anything reads them as text.

Defined results: a null text is an empty text (no tokens, no bytes); null packed ids decode to null; strings that look
like special tokens are plain text; repeated rows each get their own result; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, parts

SEGMENT = 50_000  # characters after which a text is cut at the next safe place; results do not depend on it
LONG_RUN = 5_000  # characters of white space that are encoded apart; results do not depend on it

# The characters that the pattern's \s means.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SAFE = re.compile(r"(?<=[!-~])[ \n]")


class RankBpe:
    """One rank file with one pattern."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.texts = tiktoken.Encoding("texts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.runs = tiktoken.Encoding("runs", pat_str=r"\s+", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str, segment: int = SEGMENT, long_run: int = LONG_RUN) -> list[int]:
        if len(text) <= min(segment, long_run):
            return self.texts.encode_ordinary(text)
        ids: list[int] = []
        for part, run in segments(text, segment, long_run):
            ids += (self.runs if run else self.texts).encode_ordinary(part)
        return ids


def segments(text: str, segment: int = SEGMENT, long_run: int = LONG_RUN) -> Iterator[tuple[str, bool]]:
    """The pieces of a text in order, each with whether it is a long run of white space (one match)."""
    at = 0
    for run in re.finditer(f"[{WHITE}]{{{max(2, long_run)},}}", text):
        yield from _cut(text, at, run.start(), segment)
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start():at], True
    yield from _cut(text, at, len(text), segment)


def _cut(text: str, at: int, end: int, segment: int) -> Iterator[tuple[str, bool]]:
    while end - at > segment:
        place = _SAFE.search(text, at + segment, end)
        if place is None:
            break
        yield text[at:place.start()], False
        at = place.start()
    if at < end:
        yield text[at:end], False


_LOADED: dict[tuple[str, str], RankBpe] = {}


def loaded(path: str, pattern: str) -> RankBpe:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = RankBpe(path, pattern)
    return _LOADED[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``packed`` (the ids, little-endian unsigned 32-bit) of every whole text. ``path`` names the rank
    file, which must be installed on every executor."""
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        bpe = loaded(path, pattern)
        for part in parts(batches):
            packed = [np.array(bpe.encode(t or ""), "<u4").tobytes() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], names=["id", "packed"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, run, f"id {id_type}, packed binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, ``packed`` and ``decoded`` (raw bytes) of packed ids. An id outside the ranks raises."""
    id_type = dict(encoded.dtypes)[id_col]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        bpe = loaded(path, pattern).texts
        for part in parts(batches):
            raw = [None if p is None else bpe.decode_bytes(np.frombuffer(p, "<u4").tolist())
                   for p in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(raw, pa.binary())],
                                             names=["id", "packed", "decoded"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col("packed"))
    return map_arrow(rows, run, f"id {id_type}, packed binary, decoded binary").withColumnRenamed("id", id_col)


def rank_rows(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: number of tokens, digests of the packed ids and of the decoded bytes."""
    return decode(encode(docs, path, pattern), path, pattern).select(
        "doc_id", (F.octet_length("packed") / 4).cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
