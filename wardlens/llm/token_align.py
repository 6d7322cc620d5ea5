"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Two tokenizers read the same bytes. A byte offset at which tokens of both end is a shared cut; between two
neighbouring shared cuts lies a group of tokens of A and of B that say the same bytes.

Method. Of an interval between two shared cuts, the token ends of A near its middle are looked up among the ends of B by
bisection, the nearest first; the first that both have splits the interval, and both halves are treated in the same
way. An interval without a common end is a leaf group. All intervals of one depth are probed together in numpy.

The intervals to begin with are the chunks of a text: a chunk starts at a blank or line feed after any other
character, where neither tokenizer joins tokens (``PieceSide`` checks its vocabulary for that; ``ByteSide``'s pattern
never holds white space after other characters). Equal chunks of a block of documents are encoded and aligned once;
a text without white space is one chunk and is divided from its ends.

Links. Every A-B pair of token occurrences of one group is a link. The count of an id pair is the number of documents in
which it is linked. One pass over the texts cuts them into blocks of about ``BLOCK_BYTES`` and stores, per block, each
distinct id pair with the number of its documents, the pairs of each chunk, and per document its chunks. Spark sums
the counts of the pairs over the blocks and finds each A id's highest; each block then gets the counts of its own
pairs (one shuffle by block), so no task holds the pairs of the corpus and no link is written out per occurrence.

Defined results: null and empty texts, and texts that a tokenizer does not give back byte by byte, have no tokens (zeros
and an empty ``groups``); strings of special tokens are plain text; every row is a document of its own, repeated rows
and null ids included; ties for an A id's highest count all count; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, map_arrow, parts, ship_code, stored

BLOCK_BYTES = 2 << 20  # text of a block; results do not depend on it
STEP = 10_000  # chunks that are handled as Python objects at once; results do not depend on it
JOIN = 16  # chunks that a library gets as one string; results do not depend on it
LOW = (1 << 32) - 1  # lower half of a pair of ids
_CHUNK = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")
_SPACE = "▁"


class ByteSide:
    """A byte-level tokenizer file; the text is given with one blank before it."""

    chunks_apart = True  # by its pattern

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; each further thread keeps memory of its own
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        # the byte-level alphabet: a byte that is no printable mark stands for a later character
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown}
        byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        names = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.raw = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.raw[i] = bytes(byte[c] for c in name)

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(chunks, add_special_tokens=False)]


class PieceSide:
    """A sentencepiece model that puts a blank before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.raw = [bytes([int(n[3:5], 16)]) if self.library.is_byte(i) else n.replace(_SPACE, " ").encode()
                    for i, n in enumerate(names)]
        self.space = self.library.piece_to_id(_SPACE)
        # whether no piece holds a blank after another character, or a line feed
        self.chunks_apart = not any(re.search(f"[^{_SPACE}]{_SPACE}|\n", n) for n in names)

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """Per chunk of a text that begins with a blank: its ids. The library puts a blank before what it
        is given, so the chunk's own first one is left out, or the library's is taken off again."""
        got = self.library.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return [[self.space] if c == " " else ids if c[0] == " " else ids[1:] for c, ids in zip(chunks, got, strict=True)]


_LOADED: dict[tuple[type, str], ByteSide | PieceSide] = {}


def loaded(kind: type, path: str):
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]


def shared_cuts(ends_a, ends_b, lo, hi):
    """The indices of A tokens, in order, that end where a token of B ends, inside the intervals of A tokens
    [lo, hi), whose own ends are shared. Offsets rise strictly on both sides."""
    import numpy as np

    found = []
    while len(lo):
        wide = hi - lo > 1
        lo, hi = lo[wide], hi[wide]
        cut = _near_middle(ends_a, ends_b, lo, hi - 1)
        split = cut >= 0
        lo, hi, cut = lo[split], hi[split], cut[split]
        found.append(cut)
        lo, hi = np.concatenate([lo, cut + 1]), np.concatenate([cut + 1, hi])
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _near_middle(ends_a, ends_b, lo, hi):
    """Per interval: an A token in [lo, hi) whose end B has, the nearest to the middle; -1 if none. The
    window about the middle doubles, so a cutless interval costs its own length."""
    import numpy as np

    middle, cut = (lo + hi) // 2, np.full(len(lo), -1, np.int64)
    still, reach, width = np.arange(len(lo)), 0, 1
    while len(still):
        off = np.arange(reach, reach + width)
        off = np.stack([off, -off], axis=1).ravel()  # the nearest first
        probe = middle[still, None] + off
        inside = (probe >= lo[still, None]) & (probe < hi[still, None])
        offset = ends_a[np.where(inside, probe, 0)]
        at = np.minimum(np.searchsorted(ends_b, offset), len(ends_b) - 1)
        hit = inside & (ends_b[at] == offset)
        got = hit.any(axis=1)
        cut[still[got]] = probe[got, hit[got].argmax(axis=1)]
        reach += width
        width = reach
        more = ~got & ((middle[still] - reach >= lo[still]) | (middle[still] + reach < hi[still]))
        still = still[more]
    return cut


def _spread(sizes):
    """For runs of the given sizes: the run of each element, and its place in the run."""
    import numpy as np

    run = np.repeat(np.arange(len(sizes)), sizes)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _sums(values, sizes):
    """Sums of runs of the given sizes (0 for an empty run)."""
    import numpy as np

    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _running(values, sizes):
    """Running sums inside each run of the given sizes."""
    import numpy as np

    total = _sums(values, sizes)
    return np.cumsum(values) - np.repeat(np.cumsum(total) - total, sizes)


def _distinct(keys, weights=None):
    """Distinct keys in order, with the number (or summed weight) of each."""
    import numpy as np

    if weights is None:
        return np.unique(keys, return_counts=True)
    values, back = np.unique(keys, return_inverse=True)
    total = np.zeros(len(values), np.int64)
    np.add.at(total, back, weights)
    return values, total


def _encoded(side, chunks: list[str]):
    """Per chunk its number of tokens and whether it is given back byte by byte, and all ids in a row. The libraries get
    ``JOIN`` chunks as one string, cut again at the chunks' ends. A chunk that ends with white space ends a string. The
    chunks of a string that is not given back, or holds a token over a chunk's end, are encoded one by one."""
    import numpy as np

    width = np.array([len(t) for t in side.raw], np.int64)
    sizes, good, flat = [np.zeros(0, np.int64)], [np.zeros(0, bool)], [np.zeros(0, np.int64)]
    for k in range(0, len(chunks), STEP):
        part = chunks[k:k + STEP]
        starts, last = [], -JOIN
        for i, c in enumerate(part):
            if i - last >= JOIN or not side.chunks_apart or part[i - 1][-1].isspace():
                starts.append(i)
                last = i
        strings = ["".join(part[s:e]) for s, e in zip(starts, [*starts[1:], len(part)], strict=True)]
        ids = side.encode(strings)
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        tokens = np.fromiter(chain.from_iterable(ids), np.int64, n.sum())
        whole = np.array([b"".join(map(side.raw.__getitem__, x)) == s.encode() for x, s in zip(ids, strings, strict=True)], bool)
        # ends of tokens and chunks inside their string
        count = np.diff(starts, append=len(part))
        bytes_of = np.fromiter((len(c.encode()) for c in part), np.int64, len(part))
        (of_token, _), (of_chunk, _) = _spread(n), _spread(count)
        token_ends = of_token << 32 | _running(width[tokens], n)
        chunk_ends = of_chunk << 32 | _running(bytes_of, count)
        at = np.searchsorted(token_ends, chunk_ends)
        met = np.append(token_ends, -1)[at] == chunk_ends
        whole &= np.bincount(of_chunk[~met], minlength=len(ids)) == 0
        size, fine = np.diff(at + 1, prepend=0), np.ones(len(part), bool)
        size[starts] = at[starts] + 1 - (np.cumsum(n) - n)
        if not whole.all():
            lone = np.flatnonzero(~whole[of_chunk]).tolist()
            found = dict(zip(lone, side.encode([part[i] for i in lone]), strict=True))
            for i, x in found.items():
                size[i], fine[i] = len(x), b"".join([side.raw[t] for t in x]) == part[i].encode()
            tokens = np.fromiter(chain.from_iterable(
                chain.from_iterable([x] if w else [found[i] for i in range(s, s + m)])
                for x, w, s, m in zip(ids, whole.tolist(), starts, count.tolist(), strict=True)), np.int64, size.sum())
        sizes.append(size)
        good.append(fine)
        flat.append(tokens)
    return np.concatenate(sizes), np.concatenate(good), np.concatenate(flat)


def _strings(vocabulary: int, last: bytes) -> list[bytes]:
    return [b"%d," % i for i in range(vocabulary)] + [b"%d%s" % (i, last) for i in range(vocabulary)]


def _pack(values) -> bytes:
    """32-bit numbers as four planes of bytes: the upper ones of small numbers are zeros, which stores compress away."""
    return values.astype("<u4").view("u1").reshape(-1, 4).T.tobytes()


def _unpack(packed: list[bytes]):
    """All packed rows one after the other."""
    import numpy as np

    rows = [np.frombuffer(p, "u1").reshape(4, -1).T.reshape(-1) for p in packed]
    return np.concatenate([np.zeros(0, "u1"), *rows]).view("<u4").astype(np.int64)


class Block:
    """The alignment of a block of texts."""

    def __init__(self, a: ByteSide, b: PieceSide, texts: Iterable[str | None]):
        import numpy as np

        index: dict[str, int] = defaultdict()
        index.default_factory = index.__len__  # a new chunk gets the next number
        self.chunks = []  # of each text
        for t in texts:
            chunks = (_CHUNK.findall(" " + t) if b.chunks_apart else [" " + t]) if t else ()
            self.chunks.append(np.fromiter(map(index.__getitem__, chunks), np.int32, len(chunks)))
        index.default_factory = None  # it holds the index
        self._align(a, b, list(index))
        del index
        sizes = np.array([len(c) for c in self.chunks], np.int64)
        flat = np.concatenate([np.zeros(0, np.int32), *self.chunks])
        # texts of which every chunk is given back
        self.whole = _sums(~self.good[flat], sizes) == 0
        row, _ = _spread(sizes)
        keep = self.whole[row]
        keys, self.times = _distinct(row[keep] << 32 | flat[keep])
        row, self.words = keys >> 32, keys & LOW
        self.sizes = np.bincount(row, minlength=len(sizes))
        self.totals = [_sums(per_chunk[self.words] * self.times, self.sizes)
                       for per_chunk in (self.n_a, self.n_b, self.n_groups, self.n_links)]
        # documents of each pair: the distinct pairs of a text's chunks
        word, place = _spread(self.pair_sizes[self.words])
        start = np.cumsum(self.pair_sizes) - self.pair_sizes
        held = self.pair_of[start[self.words[word]] + place]
        self.holders = np.bincount(np.unique(row[word] << 32 | held) & LOW, minlength=len(self.keys))

    def groups(self, text: int) -> bytes:
        """The groups of a text as ``a1,a2|b1;a3|b2``."""
        return b"".join([self.shown[c] for c in self.chunks[text].tolist()])[:-1] if self.whole[text] else b""

    def _align(self, a: ByteSide, b: PieceSide, chunks: list[str]) -> None:
        """Groups and links of the distinct chunks."""
        import numpy as np

        sides = [_encoded(side, chunks) for side in (a, b)]
        self.good = sides[0][1] & sides[1][1]
        flat = [x[np.repeat(self.good, n)] for n, _, x in sides]
        sizes = [n[self.good] for n, _, _ in sides]
        del sides
        ends = [np.cumsum(np.array([len(t) for t in side.raw], np.int64)[x]) for side, x in zip((a, b), flat, strict=True)]
        hi = np.cumsum(sizes[0])
        cuts = shared_cuts(*ends, hi - sizes[0], hi)
        # groups: ends (exclusive) in tokens of A and of B
        end_a = np.sort(np.concatenate([cuts + 1, hi]))
        end_b = np.searchsorted(ends[1], ends[0][end_a - 1]) + 1
        size_a, size_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
        chunk = np.searchsorted(hi, end_a)  # of each group, among the good ones
        (group_a, _), (group_b, _) = _spread(size_a), _spread(size_b)

        count = len(chunks)
        good = np.flatnonzero(self.good)
        groups = np.bincount(chunk, minlength=len(good))

        def per_chunk(values):
            out = np.zeros(count, np.int64)
            out[good] = values
            return out

        self.n_a, self.n_b, self.n_groups = per_chunk(sizes[0]), per_chunk(sizes[1]), per_chunk(groups)
        self.n_links = per_chunk(_sums(size_a * size_b, groups))

        # a1,a2|b1; for each group, as one row of marks
        if not hasattr(a, "marks"):
            a.marks = _strings(len(a.raw), b"|")
        if not hasattr(b, "marks"):
            b.marks = _strings(len(b.raw), b";")
        marks, after = a.marks + b.marks, len(a.marks)
        code = np.zeros(len(flat[0]) + len(flat[1]), np.int32)
        last_a, last_b = np.zeros(len(flat[0]), np.int64), np.zeros(len(flat[1]), np.int64)
        last_a[end_a - 1], last_b[end_b - 1] = 1, 1
        code[np.arange(len(flat[0])) + (end_b - size_b)[group_a]] = flat[0] + len(a.raw) * last_a
        code[np.arange(len(flat[1])) + end_a[group_b]] = flat[1] + len(b.raw) * last_b + after
        at = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        self.shown: list[bytes] = []
        for k in range(0, count, STEP):
            ends_here = at[k:k + STEP + 1] - at[k]
            here, spans = code[at[k]:at[k] + ends_here[-1]].tolist(), ends_here.tolist()
            self.shown += [b"".join([marks[m] for m in here[s:e]]) for s, e in zip(spans, spans[1:], strict=False)]

        # links: the distinct ids of a group on both sides, with their numbers
        (of_a, times_a), (of_b, times_b) = _distinct(group_a << 32 | flat[0]), _distinct(group_b << 32 | flat[1])
        distinct_b = np.bincount(of_b >> 32, minlength=len(end_a))
        left, place = _spread(distinct_b[of_a >> 32])
        right = (np.cumsum(distinct_b) - distinct_b)[of_a[left] >> 32] + place
        self.keys, index = np.unique((of_a[left] & LOW) << 32 | of_b[right] & LOW, return_inverse=True)
        entries, self.pair_times = _distinct(good[chunk[of_a[left] >> 32]] << 32 | index, times_a[left] * times_b[right])
        self.pair_of = entries & LOW
        self.pair_sizes = np.bincount(entries >> 32, minlength=count)


_COLUMNS = ("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, block bigint, words binary, "
            "times binary, pair_keys array<bigint>, holders array<int>, pair_sizes binary, pair_of binary, pair_times binary")


def _blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """One row per document (``words`` is set) and one per block (``pair_keys`` is set)."""
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        a, b = loaded(ByteSide, a_path), loaded(PieceSide, b_path)
        task, number, size, held = TaskContext.get().partitionId(), 0, 0, []

        def rows():
            ids = pa.chunked_array([i for i, _ in held]).combine_chunks()
            got = Block(a, b, chain.from_iterable(t.to_pylist() for _, t in held))
            block = task << 32 | number
            ends = np.cumsum(got.sizes)
            # a text's chunks rise: only the steps are stored
            steps, starts = np.diff(got.words, prepend=0), (ends - got.sizes)[got.sizes > 0]
            steps[starts] = got.words[starts]
            types = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]
            for k in range(0, len(ids), 200):
                some = range(k, min(k + 200, len(ids)))
                n, spans = len(some), [slice(ends[i] - got.sizes[i], ends[i]) for i in some]
                yield pa.RecordBatch.from_arrays([
                    ids[k:k + n], *(pa.array(t[k:k + n]) for t in got.totals), pa.array([got.groups(i) for i in some], pa.string()),
                    pa.array(np.full(n, block)), pa.array([_pack(steps[x]) for x in spans], pa.binary()),
                    pa.array([_pack(got.times[x]) for x in spans], pa.binary()), *(pa.nulls(n, t) for t in types)], names=names)
            lists = [[got.keys], [got.holders.astype(np.int32)], [_pack(got.pair_sizes)], [_pack(got.pair_of)],
                     [got.pair_times.astype("<i8").tobytes()]]
            yield pa.RecordBatch.from_arrays([
                pa.nulls(1, ids.type), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), pa.array([block]),
                pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                *(pa.array(x, t) for x, t in zip(lists, types, strict=True))], names=names)

        for part in parts(batches):
            held.append((part.column(0), part.column(1)))
            size += part.column(1).nbytes
            if size >= BLOCK_BYTES:
                yield from rows()
                number, size, held = number + 1, 0, []
                give_back()
        if held:
            yield from rows()
        held.clear()
        give_back()

    names = ["id", *(c.split()[0] for c in _COLUMNS.split(", "))]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, run, f"id {id_type}, {_COLUMNS}")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links`` and ``groups``: the groups in order as
    ``a1,a2|b1;a3|b2,b3`` (ids of A, then of B). The vocabulary files must be installed on every executor."""
    return (_blocks(docs, a_path, b_path, id_col, text_col).filter("words is not null")
            .select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "groups"))


def _block_pairs(blocks: DataFrame) -> DataFrame:
    pairs = F.posexplode(F.arrays_zip("pair_keys", "holders")).alias("pos", "p")
    return (blocks.filter("pair_keys is not null").select("block", pairs)
            .select("block", "pos", F.col("p.pair_keys").alias("pair"), F.col("p.holders").alias("n")))


def _pair_counts(blocks: DataFrame) -> DataFrame:
    """Each id pair, its count and whether that is its A id's highest. An A id has no more pairs than B has tokens."""
    counts = (_block_pairs(blocks).groupBy("pair").agg(F.sum("n").alias("count"))
              .withColumn("a_id", F.shiftright("pair", 32).cast("int")))
    top = counts.groupBy("a_id").agg(F.max("count").alias("top"))
    return counts.join(top, "a_id").select("pair", "a_id", "count", (F.col("count") == F.col("top")).alias("best"))


def pair_counts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """``a_id``, ``b_id``, ``n_docs`` (documents in which the two are linked) and ``best`` (the A id's highest)."""
    blocks = _blocks(docs.select(F.lit(None).cast("int").alias("id"), text_col), a_path, b_path, "id", text_col)
    kept = stored(blocks.filter("pair_keys is not null").select("block", "pair_keys", "holders"), "align-pairs")
    return _pair_counts(kept).filter("count > 0").select(
        "a_id", F.col("pair").bitwiseAND(F.lit(LOW)).cast("int").alias("b_id"), F.col("count").alias("n_docs"), "best")


def _score(block, counts):
    """The documents of one block with ``n_best`` and ``count_sum``; ``counts`` has the block's pairs."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    whole = block.filter(pc.is_null(block["words"]))
    block = block.filter(pc.is_valid(block["words"]))
    out = [block[c] for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
    names = ["id", "n_a", "n_b", "n_groups", "n_links"]
    pos = counts["pos"].to_numpy()
    sizes, pair_of = (_unpack([whole[c][0].as_py()]) for c in ("pair_sizes", "pair_of"))
    pair_times = np.frombuffer(whole["pair_times"][0].as_py(), "<i8")
    steps, times = (_unpack(block[c].to_pylist()) for c in ("words", "times"))
    per_doc = pc.binary_length(block["words"]).to_numpy().astype(np.int64) // 4
    words = np.cumsum(steps)
    start = np.cumsum(per_doc) - per_doc
    words -= np.repeat(np.concatenate([[0], words])[start], per_doc)
    for name, column in (("n_best", "best"), ("count_sum", "count")):
        value = np.zeros(len(pos), np.int64)
        value[pos] = counts[column].to_numpy()
        per_chunk = _sums(value[pair_of] * pair_times, sizes)
        out.append(pa.array(_sums(per_chunk[words] * times, per_doc)))
        names.append(name)
    return pa.table([*out, block["digest"]], names=[*names, "digest"])


def align_rows(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: numbers of tokens, groups and links, ``n_best`` (links whose pair has its A id's highest
    count), ``count_sum`` (the counts of all links) and a digest of ``groups``."""
    id_type = dict(docs.dtypes)["doc_id"]
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    blocks = stored(_blocks(docs, a_path, b_path, "doc_id", "text").withColumn("digest", digest).drop("groups"), "align")
    counts = _pair_counts(blocks).select("pair", F.col("count"), F.col("best").cast("long").alias("best"))
    counts = _block_pairs(blocks).drop("n").join(counts, "pair").select(
        F.col("block").alias("of_block"), "pos", "count", "best")
    ship_code(docs.sparkSession)
    texts = blocks.select("id", "n_a", "n_b", "n_groups", "n_links", "digest", "block", "words", "times",
                          "pair_sizes", "pair_of", "pair_times")
    return (texts.groupBy("block").cogroup(counts.groupBy("of_block"))
            .applyInArrow(_score, f"id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
                                  "count_sum bigint, digest string")
            .withColumnsRenamed({"id": "doc_id", "digest": "groups_sha256"}))
