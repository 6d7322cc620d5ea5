"""Secret scan by grammar inference.

1. One pass over all whole texts finds the base matches and all other runs of credential characters of ``MIN_RUN`` or
   more. It hands on the strings of the base matches (the labelled credentials) and of the other runs; the distinct
   ones of each class are stored, all of them and of any length.
2. A prefix tree with counts is built of all distinct strings of each class. Spark sorts them, a task walks its part of the
   tree with one open path, and nodes that several tasks meet are summed. The driver gets the nodes that at least one in
   ``states`` strings passes, to a depth of ``DEPTH`` (the model's resolution; their counts are those of all strings).
3. The tree's states are merged red-blue: a state joins another when no outgoing or stopping frequency of theirs,
   nor of the states they lead to, differs by more than the Hoeffding bound. What is too rare for a node of its own leads
   to the start, the first state that merging tries. All strings are then read by the automaton, from their first to their
   last character, and its frequencies are counted again. The result is a probabilistic automaton per class.
4. The other runs hold secrets too, perhaps many of one format, and must not teach that such strings are none. So a run that
   a credential automaton of its length explains at least as well as the automaton of all other runs is taken out, and that
   automaton is inferred again from all the rest, until nothing changes. A benign format (card numbers, say) is explained
   better by the other runs and stays.
5. A second pass scores every run whose length labelled credentials have, by its likelihood per character under the
   credential automata of that length against the others; spans at or above ``threshold`` are added to the base spans.

Defined results: a null text is empty (no spans); repeated rows each get their own result; with no
labelled credential in the corpus there is no automaton and only base spans remain; an empty table gives
an empty result; other columns of the input are ignored by the scan and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, mark, release, stored

# Base kinds and patterns, in the order of the kinds.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32

# Runs that can hold a credential. Access keys and hex strings of base length lie inside one.
MIN_RUN = 8
HELD = 8 << 20  # characters that a task holds before it hands them on; results do not depend on it
DEPTH = 100  # characters at the beginning of a string by which states are told apart
RUN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
ADDED = "grammar"
ALPHABET = 67  # characters of RUN and "."
SLACK = 0.02  # nats per character by which the other runs' automaton may be better and a run still count as explained


def find_spans(text: str) -> list[tuple[str, int, int, str]]:
    """Base matches (kind, start, end, credential) and the other runs (kind ``ADDED``) that no base match touches, by
    start then kind."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    runs = [(m.start(), m.end(), m[0]) for m in RUN.finditer(text)]
    for s, _, run in runs:
        if "AKIA" in run:
            found += [("access", s + x.start(), s + x.end(), x[0]) for x in ACCESS.finditer(run)
                      if len(x[0]) >= MIN_ACCESS]
        if len(run) >= MIN_HEX:
            found += [("hex", s + x.start(), s + x.end(), x[0]) for x in HEX.finditer(run) if len(x[0]) >= MIN_HEX]
    if not found:
        return [(ADDED, *run) for run in runs]
    covered: list[list[int]] = []  # union of the base spans
    for _, start, end, _ in sorted(found, key=lambda x: x[1]):
        if covered and start < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    k = 0
    for start, end, run in runs:
        while k < len(covered) and covered[k][1] <= start:
            k += 1
        if not (k < len(covered) and covered[k][0] < end):
            found.append((ADDED, start, end, run))
    order = {k: i for i, k in enumerate((*KINDS, ADDED))}
    found.sort(key=lambda x: (x[1], order[x[0]]))
    return found


def credential_values(docs: DataFrame, text_col: str) -> DataFrame:
    """``kind``, ``value``: the distinct strings of all base matches and of all other runs (kind ``ADDED``), stored."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: set[tuple[str, str]] = set()

        def rows():
            kinds, strings = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(strings, pa.string())], names=["kind", "value"])

        size = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for kind, _, _, value in find_spans(text or ""):
                    if (kind, value) not in held:
                        held.add((kind, value))
                        size += len(value) + 100  # of the Python objects
                if size > HELD:
                    yield rows()
                    held, size = set(), 0
        if held:
            yield rows()

    found = map_arrow(docs.select(F.col(text_col).alias("text")), run, "kind string, value string")
    return stored(found.distinct(), "secret-values")


# Probabilistic automata

@dataclass
class State:
    n: int = 0
    stops: int = 0
    to: dict[str, int] = field(default_factory=dict)
    by: Counter = field(default_factory=Counter)


def _differ(f1: int, n1: int, f2: int, n2: int, bound: float) -> bool:
    if not n1 or not n2:
        return False
    return abs(f1 / n1 - f2 / n2) > bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))


class Automaton:
    """A probabilistic automaton inferred by merging compatible prefix-tree states, of strings or of a tree's ``nodes``:
    per prefix how often each character follows ("": the end)."""

    def __init__(self, strings: list[str], alpha: float = 0.05, alphabet: int = ALPHABET,
                 nodes: dict[str, dict[str, int]] | None = None):
        self.alphabet = alphabet
        if nodes is None:
            nodes = {}
            for s in strings:
                for d in range(min(len(s), DEPTH) + 1):
                    after = nodes.setdefault(s[:d], {})
                    after[s[d:d + 1]] = after.get(s[d:d + 1], 0) + 1
        number = {p: i for i, p in enumerate(nodes)} if nodes else {"": 0}
        self.states = [State() for _ in number]
        for p, after in nodes.items():
            here = self.states[number[p]]
            here.n, here.stops = sum(after.values()), after.get("", 0)
            here.by = Counter({c: n for c, n in after.items() if c})
            here.to = {c: number[p + c] for c in here.by if p + c in number}
        self._merge(math.sqrt(0.5 * math.log(2 / alpha)))
        for s in self.states:  # what is too rare for a state of its own
            for c in s.by:
                s.to.setdefault(c, 0)
        if strings and max(map(len, strings)) > DEPTH:
            self.recount(self.moves(strings))

    def moves(self, strings: list[str]) -> Counter:
        """How often the strings take each (state, character) ("": stop)."""
        found: Counter = Counter()
        for s in strings:
            at = 0
            for c in s:
                found[at, c] += 1
                at = self.states[at].to.get(c, at)
            found[at, ""] += 1
        return found

    def recount(self, moves: dict[tuple[int, str], int]) -> None:
        """Frequencies from the moves of all strings."""
        for s in self.states:
            s.n, s.stops, s.by = 0, 0, Counter()
        for (at, c), n in moves.items():
            s = self.states[at]
            s.n += n
            if c:
                s.by[c] += n
            else:
                s.stops += n

    def _compatible(self, a: int, b: int, bound: float) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = (self.states[k] for k in todo.pop())
            if _differ(x.stops, x.n, y.stops, y.n, bound):
                return False
            for c in x.by.keys() | y.by.keys():
                if _differ(x.by[c], x.n, y.by[c], y.n, bound):
                    return False
                if c in x.to and c in y.to:
                    todo.append((x.to[c], y.to[c]))
        return True

    def _fold(self, a: int, b: int) -> list[tuple[int, str]]:
        """Add the tree under b to state a. The (state, character) that lead to a moved tree."""
        todo, moved = [(a, b)], []
        while todo:
            a, b = todo.pop()
            x, y = self.states[a], self.states[b]
            x.n += y.n
            x.stops += y.stops
            x.by.update(y.by)
            for c, k in y.to.items():
                if c in x.to:
                    todo.append((x.to[c], k))
                else:
                    x.to[c] = k
                    moved.append((a, c))
        return moved

    def _merge(self, bound: float) -> None:
        red = {0: None}  # in the order of joining
        blue = sorted((0, c) for c in self.states[0].to)  # a heap; what has become red meanwhile is passed over
        while blue:
            parent, c = heapq.heappop(blue)
            k = self.states[parent].to[c]
            if k in red:
                continue
            home = next((r for r in red if self._compatible(r, k, bound)), None)
            if home is None:
                red[k] = None
                new = [(k, x) for x in self.states[k].to]
            else:
                self.states[parent].to[c] = home
                new = [m for m in self._fold(home, k) if m[0] in red]
            for m in new:
                heapq.heappush(blue, m)
        number = {r: i for i, r in enumerate(red)}
        self.states = [self.states[r] for r in red]
        for s in self.states:
            s.to = {c: number[t] for c, t in s.to.items()}

    def log_likelihood(self, text: str) -> float:
        """Natural log of the string's probability, add-half smoothed; a character that a state has
        not seen leaves the state as it is."""
        at, total = 0, 0.0
        for c in text:
            s = self.states[at]
            total += math.log((s.by.get(c, 0) + 0.5) / (s.n + 0.5 * (self.alphabet + 1)))
            at = s.to.get(c, at)
        s = self.states[at]
        return total + math.log((s.stops + 0.5) / (s.n + 0.5 * (self.alphabet + 1)))


@dataclass
class Grammar:
    credentials: dict[str, Automaton]
    lengths: dict[str, set[int]]
    others: Automaton | None
    threshold: float
    known: dict[str, float | None] = field(default_factory=dict)  # scores of strings, forgotten when there are many

    def best(self, text: str) -> float | None:
        """Log likelihood of the best credential format that has the text's length."""
        return max((a.log_likelihood(text) for k, a in self.credentials.items() if len(text) in self.lengths[k]), default=None)

    def plain(self, text: str) -> float:
        return self.others.log_likelihood(text) if self.others else -len(text) * math.log(ALPHABET)

    def score(self, text: str) -> float | None:
        """Likelihood per character of the best credential format against the other runs (nats); None if no format has that
        length."""
        if text not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            best = self.best(text)
            self.known[text] = None if best is None else (best - self.plain(text)) / len(text)
        return self.known[text]

    def adds(self, kind: str, text: str) -> bool:
        """Whether a span is kept: all base spans are, and other runs at or above the threshold."""
        if kind != ADDED:
            return True
        score = self.score(text)
        return score is not None and score >= self.threshold

    def explained(self, text: str, best: float | None) -> bool:
        """Whether a credential automaton explains a run at least as well as the automaton of all others does."""
        return best is not None and best >= self.plain(text) - SLACK * len(text)

    def infer_others(self, runs: list[str]) -> None:
        """The automaton of the runs that no credential automaton explains."""
        best = {t: self.best(t) for t in runs}
        rest = runs
        while True:
            self.others = Automaton(rest) if rest else None
            left = [t for t in rest if not self.explained(t, best[t])]
            if len(left) == len(rest):
                return
            rest = left


def tree_nodes(values: DataFrame, least: int) -> dict[str, dict[str, int]]:
    """The prefix tree of all distinct strings ``value``: per prefix of up to DEPTH characters that at least ``least`` of
    them have, how often each character follows ("": the end). At most DEPTH times the strings by ``least`` come back."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        out: list[tuple[str, str, int]] = []
        path: list[list] = []  # open nodes: what follows, strings that pass, whether the task began in it
        last = None

        def close(depth: int, end: bool = False) -> None:
            """Neighbouring tasks may hold more strings of the nodes a task begins or ends in: these go on anyway."""
            while len(path) > depth:
                after, n, first = path.pop()
                if n >= least or first or end:
                    out.extend((last[:len(path)], c, k) for c, k in after.items())
                if path:
                    path[-1][0][last[len(path) - 1]] = n
                    path[-1][1] += n

        def rows():
            prefixes, chars, counts = zip(*out, strict=True)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(prefixes, pa.string()), pa.array(chars, pa.string()),
                                               pa.array(counts, pa.int64())], names=["prefix", "c", "n"])

        for batch in batches:
            for value in batch.column(0).to_pylist():
                first = last is None
                if not first:
                    depth, most = 0, min(len(path) - 1, len(value))
                    while depth < most and last[depth] == value[depth]:
                        depth += 1
                    close(depth + 1)
                last = value
                path.extend([{}, 0, first] for _ in range(min(len(value), DEPTH) + 1 - len(path)))
                after, c = path[-1][0], value[len(path) - 1:len(path)]
                after[c] = after.get(c, 0) + 1
                path[-1][1] += 1
                if len(out) > 10_000:
                    yield rows()
        close(0, end=True)
        if out:
            yield rows()

    ordered = values.select("value").repartitionByRange("value").sortWithinPartitions("value")
    nodes = (map_arrow(ordered, run, "prefix string, c string, n bigint").groupBy("prefix", "c").agg(F.sum("n").alias("n"))
             .groupBy("prefix").agg(F.collect_list(F.struct("c", "n")).alias("after"), F.sum("n").alias("passed"))
             .filter(F.col("passed") >= least).drop("passed"))
    found = {r["prefix"]: {x["c"]: x["n"] for x in r["after"]} for r in nodes.collect()}
    return {p: dict(sorted(found[p].items())) for p in sorted(found)}


def fitted(values: DataFrame, total: int, states: int) -> Automaton:
    """The automaton of all ``total`` distinct strings ``value``: its states from the prefixes that one in ``states`` of them
    has, its frequencies from all of them."""
    automaton = Automaton([], nodes=tree_nodes(values, -(-total // states)))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found: Counter = Counter()
        for batch in batches:
            found.update(automaton.moves(batch.column(0).to_pylist()))
        if found:
            at, chars = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(chars, pa.string()),
                                              pa.array(list(found.values()), pa.int64())], names=["at", "c", "n"])

    moves = map_arrow(values.select("value"), run, "at int, c string, n bigint").groupBy("at", "c").agg(F.sum("n").alias("n"))
    automaton.recount({(r["at"], r["c"]): r["n"] for r in moves.collect()})  # bounded: states times characters
    return automaton


def _infer_others(grammar: Grammar, runs: DataFrame, total: int, states: int) -> None:
    """``Grammar.infer_others`` of all other runs on Spark."""

    def rated(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            values = batch.column(0)
            yield pa.RecordBatch.from_arrays([values, pa.array([grammar.best(t) for t in values.to_pylist()], pa.float64())],
                                             names=["value", "best"])

    def left(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keep = [not grammar.explained(t, b) for t, b in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    rest = stored(map_arrow(runs.select("value"), rated, "value string, best double"), "secret-runs")
    while True:
        grammar.others = fitted(rest, total, states) if total else None
        since = mark()
        kept = stored(map_arrow(rest, left, rest.schema), "secret-runs")
        n = kept.count()
        release(rest.sparkSession, since - 1, keep=1)
        if n == total:
            return
        rest, total = kept, n


def infer(docs: DataFrame, text_col: str, states: int, threshold: float) -> Grammar:
    """Automata of all labelled credentials by kind, and of all other runs. The strings of a class are collected if they are
    no more than ``states``; else Spark counts them and the driver gets the frequent nodes of their tree. The lengths that
    labelled credentials have are collected with their numbers (a row per length)."""
    values = credential_values(docs, text_col)
    sizes = values.groupBy("kind", F.length("value").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    lengths: dict[str, set[int]] = {k: set() for k in KINDS}
    total = dict.fromkeys((*KINDS, ADDED), 0)
    for r in sizes.withColumn("length", F.when(F.col("kind") != ADDED, F.col("length"))).groupBy("kind", "length").agg(
            F.sum("n").alias("n")).collect():
        total[r["kind"]] += r["n"]
        if r["kind"] != ADDED:
            lengths[r["kind"]].add(r["length"])

    def strings(kind):
        return values.filter(F.col("kind") == kind).select("value")

    def collected(kind):
        return sorted(r["value"] for r in strings(kind).collect())

    grammar = Grammar({k: Automaton(collected(k)) if total[k] <= states else fitted(strings(k), total[k], states)
                       for k in KINDS if total[k] >= 10}, lengths, None, threshold)
    if grammar.credentials and total[ADDED] <= states:
        grammar.infer_others(collected(ADDED))
    elif grammar.credentials:
        _infer_others(grammar, strings(ADDED), total[ADDED], states)
    return grammar


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, states: int = 1000,
                threshold: float = 0.4) -> DataFrame:
    """``id_col`` and ``spans``: array<struct<kind, start, end, score>> by start then kind (code points,
    end exclusive), one row per input row. Base spans have no score. One in ``states`` strings of a
    class must pass a node for it to count (all strings are fitted on); ``threshold`` is in nats per character."""
    grammar = infer(docs, text_col, states, threshold)
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("score", pa.float64())]))
        for batch in batches:
            out = [[{"kind": k, "start": a, "end": b, "score": grammar.score(v) if k == ADDED else None}
                    for k, a, b, v in find_spans(t or "") if grammar.adds(k, v)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (map_arrow(rows, run, f"id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")
            .withColumnRenamed("id", id_col))


def listing(spans, kinds: tuple[str, ...]):
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_rows(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of the base spans, all spans."""
    spans = F.col("spans")
    counts = [F.size(F.filter(spans, lambda s: s["kind"] == F.lit("assign"))).cast("long").alias("n_assign"),
              F.size(F.filter(spans, lambda s: s["kind"] == F.lit("access"))).cast("long").alias("n_access"),
              F.size(F.filter(spans, lambda s: s["kind"] == F.lit("hex"))).cast("long").alias("n_hex")]
    return secret_scan(docs).select(
        "doc_id", *counts, F.sha2(listing(spans, KINDS), 256).alias("base_sha256"),
        listing(spans, (*KINDS, ADDED)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[REDACTED]", *, states: int = 1000,
           threshold: float = 0.4) -> DataFrame:
    """The input with every span of its texts replaced by ``mark`` (overlapping spans by one mark). The
    columns stay; a null text stays null. The spans are found again while the text is at hand, so no text
    is shuffled."""
    grammar = infer(docs, text_col, states, threshold)
    names = docs.columns
    where = names.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = []
            for text in batch.column(where).to_pylist():
                out, at = [], 0
                for kind, start, end, value in find_spans(text or ""):
                    if not grammar.adds(kind, value):
                        continue
                    if start >= at:
                        out += [text[at:start], mark]
                    at = max(at, end)
                texts.append(text if not out else "".join(out) + text[at:])
            columns = list(batch.columns)
            columns[where] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(docs, run, docs.schema)


def digest(spans: list[tuple[str, int, int]]) -> str:
    """The digest of base spans, stated plainly (used by tests)."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
