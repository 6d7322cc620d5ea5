import collections
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import doc
from wardlens.llm import line_rules


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, grams = len(w), collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(n - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


PROSE = "This is a sentence of ten words that ends in one."


def test_edge_texts_against_brute_force(make):
    texts = [None, "", "   ", "\n\n\n", "a", "a b c d e", "a b c d e " * 3, "x " * 30_000, PROSE + "\n" + PROSE,
             "\t\x0b\x0c\r    ", "é € 🎉 ünï\n" * 4, "a b c d e f a b c d e g a b c d e", "#*$%&|<> " * 5]
    docs = make([doc(i, t) for i, t in enumerate(texts)] + [doc(1, ""), doc(None, None)])
    rows = line_rules.quality_rules(docs).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        want = brute(texts[r.doc_id]) if r.doc_id is not None else brute(None)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.base_failed and r.kept)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab \n#.", max_size=60), min_size=1, max_size=30))
def test_random_texts(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for r in line_rules.quality_rules(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(
            texts[r.doc_id])


def test_lines_go_first_then_documents(make):
    menu = "Home | News | Sport | Weather | Contact"
    shout = "BUY!! NOW!! CHEAP!! WATCHES!!"
    good = "\n".join(f"Sentence number {k} of this clean text has quite a few words in it." for k in range(6))
    docs = make([doc(0, good), doc(1, good + "\n" + menu), doc(2, "\n".join([shout, menu] * 3) + "\n" + PROSE),
                 doc(3, good + "\nAll rights reserved."), doc(4, good + "\nShare")])
    got = {r.doc_id: r for r in line_rules.clean_lines(docs).collect()}
    assert got[0].clean_text == good and got[0].failed_rules == "" and got[0].line_kept
    assert got[1].clean_text == good and got[1].failed_rules == "navigation" and got[1].line_kept
    assert got[2].clean_text == PROSE and not got[2].line_kept and got[2].failed_rules == "navigation,punctuation"
    assert got[3].failed_rules == "boilerplate" and got[3].n_removed_lines == 1 and got[3].line_kept
    assert got[4].failed_rules == "punctuation"


def test_empty_table_and_clashing_columns(make):
    empty = make([], "doc_id bigint, text string")
    assert line_rules.quality_rules(empty).count() == 0
    extra = make([doc(1, PROSE)]).withColumn("clean_text", F.lit(7)).withColumn("n_words", F.lit("x"))
    row = line_rules.clean_lines(extra).first()
    assert row.clean_text == PROSE and row.n_words == "x"
    assert line_rules.quality_rules(extra).first().n_words == 11


def test_no_python_in_the_plan(make):
    plan = line_rules.quality_rules(make([doc(1, PROSE)]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan.split("\n", 1)[1].replace("ExistingRDD", ""))
