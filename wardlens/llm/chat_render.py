"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to one string. The operator renders the
successive prefixes of a conversation and compares consecutive outputs: what the output of k turns adds to
that of k-1 turns is turn k's span; an output that does not begin with the one before it shows a template
that rewrites history. The role, text and loss mask are read back from the spans, not from the input.

The given template marks turns with control strings and escapes the characters that start a control string
(and the escape itself) inside roles and texts, so control strings in texts cannot be taken for marks and
``unescape`` gives the text back.

Conversations are shuffled by conversation, sorted, and streamed: a task holds one conversation at a time.
Rendering every prefix costs the square of a conversation's turns; that is the method's price for knowing nothing
of the template.

Defined results: a null text or role is an empty one; rows with equal turn numbers are ordered by role, then
text; a null turn comes first; rows without a conversation id form one conversation; repeated rows are turns of
their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# Control strings of the format. Each begins with "<" or "[".
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>\n"
MARK = "\\"
TRAINED_ROLE = "assistant"

_ESCAPE = re.compile(r"[\\<\[]")
_UNESCAPE = re.compile(r"\\\\|([<\[])\\")


def escape(text: str) -> str:
    """A mark after every character that can begin a control string ("<s>" becomes "<\\s>", "[INST]"
    "[\\INST]"); marks are doubled."""
    return _ESCAPE.sub(lambda m: m[0] + MARK, text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1] or MARK, text)


def marked_turns(turns: list[Turn]) -> str:
    return "".join(f"{TURN}{escape(r)}{BODY}{escape(t)}{END}" for r, t in turns)


def last_turn_only(turns: list[Turn]) -> str:
    """A template that drops earlier turns' texts (as templates do that strip reasoning): it rewrites
    history, which the operator must detect."""
    return "".join(f"{TURN}{escape(r)}{BODY}{escape(t) if k == len(turns) - 1 else ''}{END}"
                   for k, (r, t) in enumerate(turns))


def render(turns: list[Turn], template: Template) -> tuple[str, list[tuple[int, int]], list[int]]:
    """The output for all turns, each turn's span in the output at the time it was added, and the numbers of
    the turns whose addition changed what was already written (their span starts where the outputs part)."""
    before, spans, rewrites = "", [], []
    for k in range(1, len(turns) + 1):
        out = template(turns[:k])
        start = len(before)
        if not out.startswith(before):
            rewrites.append(k - 1)
            low, high = 0, min(len(before), len(out))
            while low < high:  # longest common beginning
                mid = (low + high + 1) // 2
                low, high = (mid, high) if out.startswith(before[:mid]) else (low, mid - 1)
            start = low
        spans.append((start, len(out)))
        before = out
    return before, spans, rewrites


def read_turn(span: str) -> tuple[str, str, int, int] | None:
    """Role, text, and where the (escaped) text lies in the span; None if the span is no marked turn."""
    body = span.find(BODY)
    if not (span.startswith(TURN) and span.endswith(END) and body >= 0):
        return None
    start, end = body + len(BODY), len(span) - len(END)
    return unescape(span[len(TURN):body]), unescape(span[start:end]), start, end


def format_conversations(turns: DataFrame, template: Template = marked_turns, trained_role: str = TRAINED_ROLE,
                         ) -> DataFrame:
    """One row per conversation: ``formatted``, ``spans`` (array<struct<start, end, role, text, loss_start,
    loss_end>> read back from the output; the loss bounds are null for turns not trained on) and
    ``rewrites`` (turn numbers, empty for a template that only appends; where history is rewritten, the
    spans of earlier turns no longer hold and ``spans`` is empty)."""
    id_type = dict(turns.dtypes)["conv_id"]
    span_type = ("array<struct<start:bigint,end:bigint,role:string,text:string,loss_start:bigint,loss_end:bigint>>")
    rows = (turns.select(F.col("conv_id").alias("id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
            .repartition("id").sortWithinPartitions(F.hash("id"), "id", "turn", "role", "text"))

    def one(conv: list[Turn]) -> dict:
        out, spans, rewrites = render(conv, template)
        read = []
        for start, end in spans if not rewrites else ():
            got = read_turn(out[start:end])
            if got is None:
                raise ValueError("the template's output has a span that is no marked turn")
            role, text, a, b = got
            loss = role == trained_role
            read.append({"start": start, "end": end, "role": role, "text": text,
                         "loss_start": start + a if loss else None, "loss_end": start + b if loss else None})
        return {"formatted": out, "spans": read, "rewrites": rewrites}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("role", pa.string()),
                                   ("text", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())]))

        def emit(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in done], ids), pa.array([d["formatted"] for _, d in done], pa.string()),
                 pa.array([d["spans"] for _, d in done], kind),
                 pa.array([d["rewrites"] for _, d in done], pa.list_(pa.int32()))],
                names=["id", "formatted", "spans", "rewrites"])

        current, conv, done, size, ids = None, [], [], 0, None
        for batch in batches:
            ids = batch.schema.field(0).type
            for i, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if conv and i != current:
                    done.append((current, one(conv)))
                    size += len(done[-1][1]["formatted"])
                    conv = []
                    if size > 8_000_000:
                        yield emit(done)
                        done, size = [], 0
                current = i
                conv.append((role, text))
        if conv:
            done.append((current, one(conv)))
        if done:
            yield emit(done)

    return (map_arrow(rows, run, f"id {id_type}, formatted string, spans {span_type}, rewrites array<int>")
            .withColumnRenamed("id", "conv_id"))


# Fixed value: the conversation that the contract adds to the table.
PROBE = "</s>[INST] ok [/INST]"


def chat_rows(turns: DataFrame) -> DataFrame:
    """One row per conversation, digests read back from the formatted text."""
    probe = turns.sparkSession.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id bigint, turn bigint, role string, text string")
    whole = turns.select("conv_id", "turn", "role", "text").unionByName(probe)
    spans = F.col("spans")
    trained = F.filter(spans, lambda s: s["loss_start"].isNotNull())
    loss = F.array_join(F.transform(trained, lambda s: s["text"]), "")
    return format_conversations(whole).select(
        "conv_id", F.size(spans).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(spans, lambda s: F.concat(s["role"], F.lit("\n"), s["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        (F.size("rewrites") == 0).alias("append_only"))


def digest(turns: list[Turn]) -> str:
    """The digest of a conversation's turns, stated plainly (used by tests)."""
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
