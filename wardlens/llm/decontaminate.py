"""Benchmark decontamination: seeds that the threshold implies, then Smith-Waterman alignment.

1. The benchmark's words get numbers; pairs of words of its items, next to each other or with one word between
   them, are the seed index. The index is sent to every task while the benchmark is under ``max_items`` items and
   ``max_words`` words (beyond it is cut in blocks of items, and the documents are passed over once per block).
2. One pass over all whole texts marks the words that the benchmark knows and finds every seed, again next to
   each other or with one word between them. Where enough places of a stretch hold seeds of an item, the
   stretch of word numbers is written. Documents without such a stretch leave nothing.
3. Each stretch is aligned with its item (match 2, mismatch -1, gap -1). The score is the best local
   alignment over the score of the item aligned with itself; from ``threshold`` on the document is contaminated
   by the item. An item of four to seven words needs 7 points (four matches, one fault), a shorter one all its words.

Nothing is lost on the way: R points by m matches leave at most 2m - R faults, so at most m - R/2 of the
m - 1 steps from match to match hold two or more, and at least R/2 - 1 steps hold one at most and are seeds, within
3n - R words of text for an item of n words. No document's verdict depends on another.

Documents with equal stretches are aligned once per task. No text is shuffled.

Words are lower-cased runs of letters, digits and underscores. An item of one word is one seed. Defined results: null texts and items are empty; empty items match nothing; repeated rows each
get a result; ties between stretches go to the first; an empty corpus or benchmark gives an empty result;
extra columns are ignored by ``contamination`` and kept by ``clean``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored

WORD = re.compile(r"\w+")
SEED = 4
PAIR, STEPS = 2, (1, 2)
COMMON = 64  # a seed at more places of the benchmark is looked up only where the rarer ones do not suffice
LEAST = 7    # points that an item of SEED words or more needs
MATCH, MISMATCH, GAP = 2, -1, -1


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class SeedIndex:
    """Seeds of benchmark items (``size`` words, each ``step`` words after the one before): word numbers, seed codes and
    where in which item each seed stands."""

    def __init__(self, items: list[tuple[int, str | None]], size: int = SEED, steps: tuple[int, ...] = (1,)):
        self.size, self.steps = size, steps
        self.ids = [i for i, _ in items]
        split = [words_of(t) for _, t in items]
        self.number = {w: k for k, w in enumerate(dict.fromkeys(w for ws in split for w in ws), 1)}
        self.words = [[self.number[w] for w in ws] for ws in split]
        # a seed: size words, or all words of a shorter item
        self.seeds: dict[tuple[int, ...], int] = {}
        self.at: list[list[tuple[int, int]]] = []
        for k, ws in enumerate(self.words):
            n = min(size, len(ws))
            for step in steps if n > 1 else (1,):
                for p in range(len(ws) - (n - 1) * step if n else 0):
                    s = self.seeds.setdefault(tuple(ws[p:p + (n - 1) * step + 1:step]), len(self.at))
                    if s == len(self.at):
                        self.at.append([])
                    self.at[s].append((k, p))
        self.tables()

    def tables(self) -> None:
        import numpy as np

        base = len(self.number) + 1
        if base ** self.size >= 1 << 63:
            raise ValueError("too many benchmark words for one index: use smaller blocks")
        self.base, self.codes = base, {}
        for n in range(1, self.size + 1):
            of = sorted((sum(w * base ** (n - 1 - k) for k, w in enumerate(s)), i)
                        for s, i in self.seeds.items() if len(s) == n)
            if of:
                self.codes[n] = (np.array([c for c, _ in of], np.int64), np.array([i for _, i in of], np.int64))

    def found(self, numbers):
        """Places and seeds, as arrays, of every seed in a text given as word numbers (0: unknown), an int64 array."""
        import numpy as np

        places, seeds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, (codes, seed) in self.codes.items():
            for step in self.steps if n > 1 else (1,):
                m = len(numbers) - (n - 1) * step
                if m <= 0:
                    continue
                whole = numbers[:m] > 0
                for k in range(1, n):
                    whole &= numbers[k * step:k * step + m] > 0
                at = np.flatnonzero(whole)
                if not len(at):
                    continue
                code = np.zeros(len(at), np.int64)
                for k in range(n):
                    code = code * self.base + numbers[at + k * step]
                spot = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                hit = codes[spot] == code
                places.append(at[hit])
                seeds.append(seed[spot[hit]])
        return np.concatenate(places), np.concatenate(seeds)

    def hits(self, numbers) -> list[tuple[int, int]]:
        """(place, seed) of every seed in a text, by place."""
        places, seeds = self.found(numbers)
        return sorted(zip(places.tolist(), seeds.tolist(), strict=True))


class PairIndex(SeedIndex):
    """Pairs of words, how many of them a stretch must hold and how long it can be for the item to reach its points."""

    def __init__(self, items: list[tuple[int, str | None]], threshold: float):
        import numpy as np

        super().__init__(items, PAIR, STEPS)
        sizes = [len(ws) for ws in self.words]
        self.points = [max(threshold * MATCH * n, min(LEAST, MATCH * n)) for n in sizes]
        need = [max(1, math.ceil(r / 2 - 1 - 1e-9)) for r in self.points]
        self.width = np.array([max(n, int(3 * n - r + 1e-9)) for n, r in zip(sizes, self.points, strict=True)], np.int64)
        # common places of an item are left out, and as many fewer are needed: none is lost by it
        common: dict[int, dict[int, int]] = {}
        for at in self.at:
            if len(at) > COMMON:
                for k, p in at:
                    common.setdefault(k, {})[p] = max(len(at), common.get(k, {}).get(p, 0))
        left_out = set()
        for k, of in common.items():
            most = sorted(of, key=lambda p: (-of[p], p))[:need[k] // 2]
            left_out.update((k, p) for p in most)
            need[k] -= len(most)
        self.need = np.array(need, np.int64)
        kept = [sorted({k for k, p in at if (k, p) not in left_out}) for at in self.at]
        self.first = np.cumsum([0, *map(len, kept)])
        self.item = np.array([k for ks in kept for k in ks], np.int64)

    def stretches(self, numbers) -> dict[int, list[list[int]]]:
        """The stretches [start, end) of a text in which an item can reach its points, by item."""
        import numpy as np

        places, seeds = self.found(numbers)
        times = self.first[seeds + 1] - self.first[seeds]
        total = int(times.sum())
        if not total:
            return {}
        nth = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
        items = self.item[np.repeat(self.first[seeds], times) + nth]
        both = np.unique(items * (len(numbers) + 1) + np.repeat(places, times))
        items, places = np.divmod(both, len(numbers) + 1)
        last = np.arange(len(both)) + self.need[items] - 1
        inside = last < len(both)
        last = np.minimum(last, len(both) - 1)
        width = self.width[items]
        enough = inside & (items[last] == items) & (places[last] - places < width)
        out: dict[int, list[list[int]]] = {}
        for item, place, w in zip(items[enough].tolist(), places[enough].tolist(), width[enough].tolist(), strict=True):
            spans = out.setdefault(item, [])
            low, high = max(0, place - w), min(len(numbers), place + w)
            if spans and low <= spans[-1][1]:
                spans[-1][1] = max(high, spans[-1][1])
            else:
                spans.append([low, high])
        return out


def align(item: list[int], text) -> tuple[int, int, int]:
    """Best local alignment of an item with a stretch of word numbers: score, and the stretch [start, end)
    that it covers. Rows of the table are vectors; a row's horizontal gaps are a running maximum."""
    import numpy as np

    b = np.asarray(text, np.int64)
    n = len(b)
    column = np.arange(n + 1)
    score, origin = np.zeros(n + 1, np.int64), column.copy()
    best = (0, 0, 0)
    for w in item:
        diagonal = score[:-1] + np.where(b == w, MATCH, MISMATCH)
        up = score[1:] + GAP
        new, start = np.zeros(n + 1, np.int64), column.copy()
        take = diagonal >= up
        inner = np.where(take, diagonal, up)
        new[1:] = np.maximum(inner, 0)
        start[1:] = np.where(inner > 0, np.where(take, origin[:-1], origin[1:]), column[1:])
        # a gap along the row costs -GAP a step: max over earlier k of new[k] + GAP * (j - k)
        level = new - GAP * column
        top = np.maximum.accumulate(level)
        reached = top + GAP * column
        better = reached > new
        if better.any():
            source = np.maximum.accumulate(np.where(level == top, column, 0))
            start = np.where(better, start[source], start)
            new = np.where(better, reached, new)
        score, origin = new, start
        k = int(score.argmax())
        if score[k] > best[0]:
            best = (int(score[k]), int(origin[k]), k)
    return best


def best_scores(pairs: list[tuple[list[int], list[int]]]) -> list[int]:
    """Scores of the best local alignments of many (item, stretch): ``align`` without places, many tables at once."""
    import numpy as np

    out = [0] * len(pairs)
    order = sorted(range(len(pairs)), key=lambda k: (len(pairs[k][1]), len(pairs[k][0])))
    while order:
        n = max(1, min(256, 100_000 // (len(pairs[order[-1]][1]) + 1)))
        part, order = order[-n:], order[:-n]
        # numbers that match nothing fill up items and stretches: they add no points
        item = np.full((max(len(pairs[k][0]) for k in part), len(part), 1), -1, np.int32)
        text = np.zeros((len(part), len(pairs[part[-1]][1])), np.int32)
        for row, k in enumerate(part):
            item[:len(pairs[k][0]), row, 0] = pairs[k][0]
            text[row, :len(pairs[k][1])] = pairs[k][1]
        column = np.arange(text.shape[1] + 1, dtype=np.int32) * np.int32(-GAP)
        score = np.zeros((len(part), text.shape[1] + 1), np.int32)
        top = np.zeros_like(score)
        for w in item:
            new = np.maximum(score + np.int32(GAP), 0)
            np.maximum(new[:, 1:], score[:, :-1] + np.where(text == w, np.int32(MATCH), np.int32(MISMATCH)), out=new[:, 1:])
            new += column
            score = np.maximum.accumulate(new, axis=1) - column
            np.maximum(top, score, out=top)
        for k, best in zip(part, top.max(1).tolist(), strict=True):
            out[k] = best
    return out


def seed_hits(docs: DataFrame, index: PairIndex, id_col: str, text_col: str) -> DataFrame:
    """A row per (document, item) that may reach its points: the stretches of word numbers to align (``starts``,
    ``stretches``)."""
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        number = index.number
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                part = whole.slice(at, 1000)
                rows, out = [], ([], [], [])
                for row, text in enumerate(part.column(1).to_pylist()):
                    numbers = np.array([number.get(w, 0) for w in words_of(text)], np.int64)
                    for item, spans in index.stretches(numbers).items():
                        rows.append(row)
                        for column, value in zip(out, (item, [a for a, _ in spans],
                                                       [numbers[a:b].tolist() for a, b in spans]), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(out[0], pa.int32()),
                     pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.list_(pa.list_(pa.int32())))],
                    names=["id", "item", "starts", "stretches"])

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run,
                     f"id {id_type}, item int, starts array<bigint>, stretches array<array<int>>")


def _block(docs: DataFrame, items: list, id_col: str, text_col: str, threshold: float) -> DataFrame:
    index = PairIndex(items, threshold)
    found = stored(seed_hits(docs, index, id_col, text_col), "seed-hits")
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known: dict[tuple, tuple[int, int, int]] = {}
        for batch in batches:
            keep, out = [], ([], [], [], [])
            columns = [batch.column(k).to_pylist() for k in (1, 2, 3)]
            if len(known) > 20_000:
                known.clear()
            new = {(item, *stretch): None for item, _, stretches in zip(*columns, strict=True) for stretch in stretches}
            new = [key for key in new if key not in known]
            for key, score in zip(new, best_scores([(index.words[key[0]], key[1:]) for key in new]), strict=True):
                # places only where the points are reached
                known[key] = align(index.words[key[0]], key[1:]) if score >= index.points[key[0]] - 1e-9 else (0, 0, 0)
            for row, (item, starts, stretches) in enumerate(zip(*columns, strict=True)):
                words = index.words[item]
                best = (0, 0, 0)
                for start, stretch in zip(starts, stretches, strict=True):
                    score, a, b = known[item, *stretch]
                    if score > best[0]:
                        best = (score, start + a, start + b)
                score = best[0] / (MATCH * len(words))
                if best[0] >= index.points[item] - 1e-9:
                    keep.append(row)
                    for column, value in zip(out, (index.ids[item], score, best[1], best[2]), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(out[0], pa.int64()),
                 pa.array(out[1], pa.float64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())],
                names=["id", "item_id", "score", "first_word", "end_word"])

    return map_arrow(
        found, run, f"id {id_type}, item_id bigint, score double, first_word bigint, end_word bigint").withColumnRenamed(
        "id", id_col)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  threshold: float = 0.5, max_items: int = 20_000, max_words: int = 2_000_000) -> DataFrame:
    """``id_col``, ``item_id``, ``score``, ``first_word`` and ``end_word`` (the aligned words of the document, from
    0, end exclusive) for every document contaminated by an item. The benchmark (columns item_id, text) is read to the
    driver in blocks of ``max_items`` items, fewer where they reach ``max_words`` words: the size bound of a block."""
    out = None
    n_words = 0
    block: list[tuple[int, str | None]] = []

    def flush():
        nonlocal out, block, n_words
        part = _block(docs, block, id_col, text_col, threshold)
        out = part if out is None else out.union(part)
        block, n_words = [], 0

    for r in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        block.append((r["item_id"], r["text"]))
        n_words += len(words_of(r["text"]))
        if len(block) == max_items or n_words >= max_words:
            flush()
    if block or out is None:
        flush()
    return out


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The documents that no item contaminates, all columns. Rows without an id are matched by their text."""
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text_col, F.lit("")))))
    marked = docs.withColumn("__key", key)
    bad = stored(contamination(marked, benchmark, "__key", text_col, **parameters).select("__key").distinct(), "leaks")
    return marked.join(bad, "__key", "left_anti").select(*docs.columns)


def leak_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item."""
    return contamination(docs, benchmark)
