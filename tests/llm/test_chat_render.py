import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardlens.llm import chat_render as c

TURNS = "conv_id bigint, turn bigint, role string, text string"


@given(st.text(alphabet="\\<[|a>]/s\n", max_size=40))
def test_escapes_are_reversible_and_hide_control_strings(text):
    out = c.escape(text)
    assert c.unescape(out) == text
    assert not any(mark.strip() in out for mark in (c.TURN, c.BODY, c.END, "</s>", "[INST]", "<s>"))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|end|>", ""]), st.text(alphabet="\\<[|end>]\n", max_size=20)),
                max_size=6))
def test_spans_read_back(turns):
    out, spans, rewrites = c.render(turns, c.marked_turns)
    assert not rewrites and [c.read_turn(out[a:b])[:2] for a, b in spans] == turns
    assert "".join(out[a:b] for a, b in spans) == out


def test_a_template_that_rewrites_history_is_detected():
    turns = [("user", "abc"), ("assistant", "def"), ("user", "g")]
    out, spans, rewrites = c.render(turns, c.last_turn_only)
    assert rewrites == [1, 2] and len(spans) == 3
    assert c.render(turns[:1], c.last_turn_only)[2] == []


def test_rows_read_back_from_the_output(make):
    rng = random.Random(1)
    rows = [(k, t, rng.choice(["user", "assistant", "system"]), rng.choice([None, "", "hi <s>", "</s>[INST] ok [/INST]", "\\"]))
            for k in range(30) for t in range(rng.randint(1, 9))]
    rows += [(50, None, None, "x"), (50, 1, "assistant", "b"), (50, 1, "assistant", "a"), (50, 1, "assistant", "a"),
             (None, 0, "user", "q"), (None, 1, "assistant", "r"), (60, 0, "user", "y" * 100_000)]
    got = {r.conv_id: r for r in c.chat_rows(make(rows, TURNS).withColumn("spans", F.lit(0))).collect()}
    want = {-7: [("user", c.PROBE), ("assistant", c.PROBE)]}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1] if r[1] is not None else -1, r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        r, loss = got[conv], "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars) == (len(turns), c.digest(turns), len(loss))
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and r.append_only
        assert r.formatted_chars == len(c.marked_turns(turns))


def test_spans_hold_in_the_formatted_text(make):
    df = c.format_conversations(make([(1, 0, "user", "a[b"), (1, 1, "assistant", "c<d")], TURNS))
    r = df.first()
    assert [(s.role, s.text) for s in r.spans] == [("user", "a[b"), ("assistant", "c<d")]
    last = r.spans[1]
    assert c.unescape(r.formatted[last.loss_start:last.loss_end]) == "c<d" and r.spans[0].loss_start is None
    rewritten = c.format_conversations(make([(1, 0, "user", "a"), (1, 1, "assistant", "b")], TURNS), c.last_turn_only).first()
    assert rewritten.rewrites == [1] and rewritten.spans == []


def test_empty_table(make):
    assert [r.conv_id for r in c.chat_rows(make([], TURNS)).collect()] == [-7]
