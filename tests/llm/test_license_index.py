import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import doc
from wardlens.llm import license_index as lic


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text):
    w = words(text)
    at = sorted((i, label) for p, label in lic.BASE for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    return (len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at})))


def base(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_base_places(make):
    texts = [None, "", "...", "MIT License", "mit-license MIT license; the Apache LICENSE", "İstanbul mit ﬁ license mit license",
             "GNU General Public License general public general public license", "mit mit license license",
             "word " * 50_000 + "Apache License", "apache\x00license", "_mit_license_", "MIT License"]
    rows = lic.license_rows(make([doc(i, t) for i, t in enumerate(texts)] + [doc(3, texts[3])])).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert base(r) == brute(texts[r.doc_id]), texts[r.doc_id][:80]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["mit", "MIT", "license", "general", "public", "apache", "x", "é", "."]), max_size=25),
                min_size=1, max_size=20))
def test_random_places(spark, texts):
    texts = [" ".join(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in lic.license_rows(docs).collect():
        assert base(r) == brute(texts[r.doc_id])


def test_templates_need_their_key_phrase(make):
    grant = lic.TEMPLATES[1].text
    docs = make([doc(0, "Intro. " + grant + " end"), doc(1, grant.replace("hereby", "maybe")),
                 doc(2, grant.replace("documentation", "doc").replace("person", "body")),
                 doc(3, "Licensed under CC BY-NC 4.0."), doc(4, "licensed under the apache license version 2 0 twice "
                 "licensed under the gnu general public license version 3"), doc(5, "nothing of the kind")])
    got = {r.doc_id: r for r in lic.license_rows(docs).collect()}
    assert got[0].labels == "mit-grant" and got[0].score == 1.0
    assert got[1].labels == "" and got[1].score == 0.0
    assert got[2].labels == "mit-grant" and 0.8 < got[2].score < 1
    assert got[3].labels == "cc-by-nc-4.0" and got[3].base_labels == ""
    assert got[4].labels == "apache,apache-2.0,gpl,gpl-3"
    assert got[5].labels == "" and got[5].first_word is None


def test_empty_table_and_clashing_columns(make):
    assert lic.license_rows(make([], "doc_id bigint, text string")).count() == 0
    extra = make([doc(1, "mit license")]).withColumn("found", F.lit(3)).withColumn("n_words", F.lit("x"))
    r = lic.license_scan(extra).first()
    assert r.n_words == 2 and [x.start for x in r.base] == [0] and r.source == "s"


def test_words_elsewhere_in_the_file_hide_no_notice(make):
    grant = lic.TEMPLATES[1].text
    cut = grant[:grant.index(" and associated")]
    rows = [doc(0, "associated documentation " + "word " * 3000 + cut + " end")]
    rows += [doc(k, grant.replace("associated documentation ", "")) for k in range(1, 6)]
    got = {r.doc_id: r for r in lic.license_rows(make(rows)).collect()}
    assert got[0].labels == "mit-grant" and got[0].score == len(cut.split()) / len(grant.split())


HEADERS = {
    "gpl-3-header": "This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public "
                    "License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.",
    "lgpl-2.1-header": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\n"
                       "License as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
    "agpl": "it under the terms of the GNU Affero General Public License as published by",
    "apache-2.0-header": "you may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n"
                         "    http://www.apache.org/licenses/LICENSE-2.0\n",
    "bsd-3-clause": "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products "
                    "derived from\n   this software without specific prior written permission.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "isc": "// SPDX-License-Identifier: ISC",
    "mit-tag": "/* SPDX-License-Identifier: MIT */",
    "gpl-2": "# SPDX-License-Identifier: GPL-2.0-or-later",
}


def test_real_headers(make):
    docs = make([doc(i, f"Some file.\n{text}\nmore words") for i, text in enumerate(HEADERS.values())])
    got = {r.doc_id: r.labels.split(",") for r in lic.license_rows(docs).collect()}
    for i, label in enumerate(HEADERS):
        assert label in got[i], (label, got[i])


def places(text, t):
    """Every place of a template, plainly."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    at, key = lambda k: words[k] if 0 <= k < len(words) else None, t.key.split()
    out = []
    for s in range(-len(t.words), len(words) + 1):
        if all(at(s + t.key_at + k) == w for k, w in enumerate(key)):
            n = sum(at(s + k) == w for k, w in enumerate(t.words)) / len(t.words)
            out += [(t.label, s, n)] if n >= 0.7 else []
    return out


def test_places_equal_the_definition_on_edited_notices(make):
    import random
    rng = random.Random(4)
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            words = rng.choice(lic.TEMPLATES).text.split()
            for _ in range(rng.randint(0, 4)):
                k = rng.randrange(len(words))
                words[k:k + 1] = rng.choice(([], ["other"], [words[k], words[k]]))
            parts += words + ["license"] * rng.randint(0, 2)
        rows.append(doc(i, " ".join(parts)))
    got = lic.license_scan(make(rows)).collect()
    for r in got:
        assert sorted((x.label, x.start, x.score) for x in r.found) == sorted(p for t in lic.TEMPLATES for p in places(r.text, t)), r.text


def test_the_plan_does_not_grow_with_the_templates(make):
    import time
    many = tuple(lic.Template(f"t{k}", " ".join(f"w{k}x{j}" for j in range(200)), " ".join(f"w{k}x{j}" for j in range(90, 95))) for k in range(100))
    docs = make([doc(i, "intro " + many[i].text + " end") for i in range(12)])
    begin = time.time()
    got = {r.doc_id: [(x.label, x.start, x.score) for x in r.found] for r in lic.license_scan(docs, templates=many).collect()}
    assert got == {i: [(f"t{i}", 1, 1.0)] for i in range(12)} and time.time() - begin < 60
    plans = [len(lic.license_scan(docs, templates=t)._jdf.queryExecution().analyzed().treeString()) for t in (many[:50], many)]
    assert plans[1] < plans[0] * 2.2
