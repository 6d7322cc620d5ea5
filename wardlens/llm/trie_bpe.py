"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct words of a batch form a trie. A depth-first walk gives every node the last token of the
encoding of its prefix: that token is the one suffix of the prefix that is a token, encodes to itself and
does not merge with the last token of what stands before it. A prefix that many words share is so
encoded once, and a word's encoding is read back by following last tokens from its end.

The walk visits the words in sorted order and keeps one stack of nodes (the trie is never stored whole),
so memory is bounded by the distinct words of one Arrow batch plus a cache of a documented size
(``CACHE_ENTRIES`` white-space chunks per Python worker; thinned when full and emptied at the end of a task,
results do not depend on it). Decoding gathers the tokens' bytes of a whole batch of ids at once.
Texts are not shuffled; each row depends on itself alone.

Normalising and splitting into words is what the tokenizer file says (its own normalizer and
pre-tokenizer run on distinct chunks); the merges are done here.

Defined results: a null text is an empty text (no tokens, digests of the empty string); repeated rows each
get their own result; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from unicodedata import is_normalized

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

CACHE_ENTRIES = 600_000
PAIR_BITS = 20
_END = 1 << 60
# A full stop or comma beside another mark: they are one word.
_JOINED = re.compile(r"[.,](?:(?=[^\w \n])|(?=_)|(?<=[^\w \n][.,])|(?<=_[.,]))")


class TrieBpe:
    """The merges of one tokenizer file, over strings of byte-level characters."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[int, str, str]] = {}
        cut = len(self.end)
        for r, pair in enumerate(model["merges"]):
            a, b = pair if not isinstance(pair, str) else pair.split(" ")
            self.rank[a, b] = r
            self.parts.setdefault(a + b, (r, a, b))
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        # the byte-level alphabet: a byte that is no printable mark stands for a later character
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.byte_marks = {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.spines: dict[tuple[str, bool], list[tuple[int, str]]] = {}
        self.pairs: dict[int, bool] = {}
        self.whole: dict[str, bool] = {}
        self.names = [""] * (max((self.vocab | self.special).values()) + 1)
        for t, i in (self.vocab | self.special).items():
            self.names[i] = t
        if len(self.names) > 1 << PAIR_BITS:
            raise ValueError("more tokens than a pair's bits hold")
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.names))]
        # tokens that encode to themselves: inside a word, and (without the suffix) at its end
        ok = [t for t in self.vocab if self.token_ok(t)]
        plain = {t for t in ok if not cut or not t.endswith(self.end)}
        self.final = {t[:-cut]: self.vocab[t] for t in ok if t.endswith(self.end)} if cut else {}
        # every beginning of such a token: its id if it is itself one of the first kind, else -1
        self.known = {t[:k]: self.vocab[t[:k]] if t[:k] in plain else -1
                      for t in (*plain, *self.final) for k in range(1, len(t) + 1)}
        self.ids_of: dict[str, bytes] = {}  # by white-space chunk, little-endian 32-bit
        self.table: tuple | None = None

    # merges

    def _spine(self, token: str, left: bool) -> list[tuple[int, str]]:
        """The tokens on one edge of a token's merge tree, innermost first, each with the rank of the
        merge that replaces it by the next one."""
        got = self.spines.get((token, left))
        if got is None:
            got, t = [(_END, token)], token
            while t in self.parts:
                r, a, b = self.parts[t]
                t = a if left else b
                got.append((r, t))
            got.reverse()
            self.spines[token, left] = got
        return got

    def _apart(self, a: str, b: str, until: int = _END) -> bool:
        """Whether no merge of rank below ``until`` crosses from token a to token b. Merges happen in
        order of rank; of equal merges the leftmost comes first."""
        x, y, i, j = self._spine(a, False), self._spine(b, True), 0, 0
        while True:
            (after_x, p), (after_y, q) = x[i], y[j]
            c = self.rank.get((p, q), _END)
            if c < until and c < after_x and c <= after_y:
                return False
            if after_x <= after_y:
                if after_x >= until:
                    return True
                i += 1
            else:
                if after_y >= until:
                    return True
                j += 1

    def pair_ok(self, pair: int) -> bool:
        """Whether two tokens stay apart; a pair is the first id times 2^PAIR_BITS plus the second."""
        if len(self.pairs) > CACHE_ENTRIES:
            self.pairs.clear()
        got = self.pairs[pair] = self._apart(self.names[pair >> PAIR_BITS], self.names[pair & (1 << PAIR_BITS) - 1])
        return got

    def token_ok(self, t: str) -> bool:
        """Whether the token's own characters encode to it."""
        got = self.whole.get(t)
        if got is None:
            if t in self.parts:
                r, a, b = self.parts[t]
                got = self.token_ok(a) and self.token_ok(b) and self._apart(a, b, r)
            else:
                got = t in self.vocab and len(t.removesuffix(self.end) if self.end else t) == 1
            self.whole[t] = got
        return got

    # the trie

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """The ids of each distinct word."""
        out: dict[str, list[int]] = {}
        known, final, pairs, pair_ok = self.known.get, self.final.get, self.pairs.get, self.pair_ok
        # by depth: id of the last token, where it starts, and the starts from which a longer token can come
        last, start, open_at, before, cut = [0], [0], [[0]], "", 1 if self.end else 0
        for word in sorted(set(words)):
            n = len(word) - cut  # nodes that other words may share
            shared, most = 0, min(n, len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1:], start[shared + 1:], open_at[shared + 1:]
            for d in range(shared + 1, n + 1):
                starts, found, at = [], -1, 0
                for j in open_at[-1]:
                    t = known(word[j:d])
                    if t is None:
                        continue
                    starts.append(j)
                    if found < 0 <= t:
                        if j:
                            ok = pairs(last[j] << PAIR_BITS | t)
                            if not ok and (ok is not None or not pair_ok(last[j] << PAIR_BITS | t)):
                                continue
                        found, at = t, j
                if found < 0:
                    raise ValueError(f"no token for a character of {word[:80]!r}")
                starts.append(d)
                last.append(found)
                start.append(at)
                open_at.append(starts)
            ids, at = [], n
            if cut:
                for j in open_at[-1]:
                    t = final(word[j:])
                    if t is not None and (not j or (
                            pairs(last[j] << PAIR_BITS | t) or pair_ok(last[j] << PAIR_BITS | t))):
                        break
                else:
                    raise ValueError(f"no token for a character of {word[:80]!r}")
                ids, at = [t], j
            before = word[:n]
            while at:
                ids.append(last[at])
                at = start[at]
            ids.reverse()
            out[word] = ids
        return out

    # texts

    def _words(self, chunk: str) -> list[str]:
        mark = chunk[-1:] if chunk[-1:] in (".", ",") else ""
        body = chunk[:-1] if mark else chunk
        if body.isascii() and body.isalpha():
            return [body.lower(), mark] if mark else [body.lower()]
        if body.isalpha() and max(body) < "\u0130" and is_normalized("NFC", body):
            # letters of the first blocks: what the file's own rules give, without the library's objects
            word = body.lower().encode().decode("latin-1").translate(self.byte_marks)
            return [word, mark] if mark else [word]
        lib = self.library
        return [w for w, _ in lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(chunk))]

    def learn(self, chunks: Iterable[str]) -> None:
        """Encode white-space chunks not seen yet."""
        new = [c for c in chunks if c not in self.ids_of]
        if not new:
            return
        split = [(c, self._words(c)) for c in new]
        of = self.encode_words(w for _, ws in split for w in ws)
        packed, ids_of = self.packed, self.ids_of
        for c, ws in split:
            ids = of[ws[0]] if len(ws) == 1 else [i for w in ws for i in of[w]]
            ids_of[c] = b"".join([packed[i] for i in ids])

    def pieces(self, text: str) -> list[str]:
        """White-space chunks (some empty) and special tokens of a text, in order. Neither the file's normal form nor
        its word pattern reaches over a blank or a line feed. Where nothing in the text depends on its
        surroundings, it is lower-cased and its full stops and commas are cut off at once, which leaves
        fewer distinct chunks."""
        if "<|" not in text or not any(s in text for s in self.special):
            if not _JOINED.search(text) and not ("Σ" in text or "İ" in text) and is_normalized("NFC", text):
                text = text.lower().replace(",", " , ").replace(".", " . ")
            return text.replace("\n", " ").split(" ")
        out: list[str] = []
        for k, part in enumerate(self.special_at.split(text)):
            out += [part] if k % 2 else part.replace("\n", " ").split(" ")
        return out

    def thin(self) -> None:
        """Forget the long chunks, which are the rare ones (all, if that is not enough)."""
        for c in [c for c in self.ids_of if len(c) > 7]:
            del self.ids_of[c]
        if len(self.ids_of) > CACHE_ENTRIES // 2:
            self.ids_of.clear()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Per text: its ids (little-endian 32-bit)."""
        if len(self.ids_of) > CACHE_ENTRIES:
            self.thin()
        self.ids_of[""] = b""
        for s, i in self.special.items():
            self.ids_of[s] = i.to_bytes(4, "little")
        split = [self.pieces(t) for t in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.ids_of.__getitem__, pieces)) for pieces in split]

    def decode_batch(self, ids, ends) -> list[str]:
        """The decoded texts of a batch: ``ids`` one after the other (int32), ``ends`` their offsets. The tokens
        are joined by a blank, as the file names no decoder."""
        import numpy as np

        if self.table is None:
            tokens = [t.encode() + b" " for t in self.names]
            sizes = np.array([len(t) for t in tokens], np.int64)
            self.table = (np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes)
        data, starts, sizes = self.table
        size = sizes[ids]
        place = np.cumsum(size) - size
        at = np.repeat((starts[ids] - place).astype(np.int32), size)
        at += np.arange(len(at), dtype=np.int32)
        text = data[at].tobytes()
        cuts = np.r_[place, len(text)][ends]
        return [text[a:max(a, b - 1)].decode() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


_LOADED: dict[str, TrieBpe] = {}


def loaded(path: str) -> TrieBpe:
    if path not in _LOADED:
        _LOADED[path] = TrieBpe(path)
    return _LOADED[path]


def bpe(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (array<int>) and ``decoded`` (the ids decoded again, special tokens kept) of every
    whole text. ``path`` names the tokenizer file, which must be installed on every executor. Decoding joins
    the tokens by a blank, as the file names no decoder."""
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tok = loaded(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                packed = tok.encode_batch([t or "" for t in part.column(1).to_pylist()])
                ends = np.cumsum([0, *(len(b) // 4 for b in packed)], dtype=np.int64)
                flat = np.frombuffer(b"".join(packed), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat)),
                     pa.array(tok.decode_batch(flat, ends), pa.string())], names=["id", "ids", "decoded"])
        tok.ids_of.clear()  # the worker may next run something else

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (map_arrow(rows, run, f"id {id_type}, ids array<int>, decoded string")
            .withColumnRenamed("id", id_col))


def bpe_rows(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: number of tokens, digests of the ids and of the decoded text."""
    return bpe(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
