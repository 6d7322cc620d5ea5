"""Licence scan by a positional rare-token index.

Each template (a licence notice, a tag or a base phrase) has a mandatory key phrase. It is indexed by the ``INDEX_WORDS``
words of that phrase with the highest inverse document frequency over the whole corpus, each with its position: a
posting word -> (template, position). In a file, the indexed words that occur are looked up, every occurrence proposes
a start (its place in the file less its position in the template), and the starts that all of a template's
indexed words propose are kept. There the key phrase must stand whole, and the score is the share of the template's words
that stand at their relative places. A place without its whole key phrase never counts, so the index loses none. Base
phrases are templates that are nothing but their key phrase.

Postings and templates are data, two literals of the plan, so the plan does not grow with the number or the length of the
templates.

All work is row-wise DataFrame expressions over one scan, after a first scan that counts document
frequencies (a partial aggregate whose result is bounded by the template words). No shuffle of texts.

Defined results: a null text is empty (no words, no places, score 0); repeated rows each get a result;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str          # mandatory phrase, part of text

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        w, k = self.words, self.key.split()
        return next(i for i in range(len(w)) if w[i:i + len(k)] == k)


def _spdx(label: str, identifier: str) -> Template:
    return Template(label, f"spdx license identifier {identifier}", f"license identifier {identifier}")


# Notices, headers and tags of common licences, as words.
TEMPLATES = (
    Template("mit-notice", "released under the mit license", "mit license"),
    Template("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this "
             "software and associated documentation files", "permission is hereby granted free of charge"),
    Template("mit-conditions", "the above copyright notice and this permission notice shall be included in all copies or "
             "substantial portions of the software", "this permission notice shall be included"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("apache-2.0-header", "you may not use this file except in compliance with the license you may obtain a copy of the "
             "license at http www apache org licenses license 2 0", "you may not use this file except in compliance with the license"),
    Template("gpl-3", "licensed under the gnu general public license version 3",
             "gnu general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2",
             "gnu general public license version 2"),
    Template("gpl-3-header", "you can redistribute it and or modify it under the terms of the gnu general public license as published "
             "by the free software foundation either version 3 of the license or at your option any later version",
             "foundation either version 3 of the license"),
    Template("gpl-2-header", "you can redistribute it and or modify it under the terms of the gnu general public license as published "
             "by the free software foundation either version 2 of the license or at your option any later version",
             "foundation either version 2 of the license"),
    Template("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    Template("lgpl-2.1-header", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
             "published by the free software foundation either version 2 1 of the license",
             "foundation either version 2 1 of the license"),
    Template("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    Template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license",
             "creative commons attribution 4 0 international"),
    Template("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license",
             "creative commons attribution sharealike 4 0 international"),
    Template("cc-by-nc-4.0", "licensed under a creative commons attribution noncommercial 4 0 international license",
             "creative commons attribution noncommercial 4 0 international"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
             "promote products derived from this software without specific prior written permission",
             "may be used to endorse or promote products derived from this software"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose",
             "permission to use copy modify"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software released into the public domain"),
    _spdx("mit-tag", "mit"), _spdx("apache-2.0", "apache 2 0"), _spdx("gpl-2", "gpl 2 0"), _spdx("gpl-3", "gpl 3 0"),
    _spdx("lgpl", "lgpl 2 1"), _spdx("lgpl", "lgpl 3 0"), _spdx("agpl", "agpl 3 0"), _spdx("bsd", "bsd 2 clause"),
    _spdx("bsd-3-clause", "bsd 3 clause"), _spdx("mpl-2.0", "mpl 2 0"), _spdx("isc", "isc"), _spdx("unlicense", "unlicense"),
)
INDEX_WORDS = 2  # of each key phrase


def words_of(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(low, BREAK, -1), "")


def document_frequency(docs: DataFrame, text_col: str, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each template word occurs; at most len(vocabulary) rows reach the driver."""
    counted = (docs.select(F.explode(F.array_intersect(words_of(F.col(text_col)), _words(vocabulary))).alias("w"))
               .groupBy("w").agg(F.count(F.lit(1)).alias("n")))
    found = {r["w"]: r["n"] for r in counted.collect()}
    return {w: found.get(w, 0) for w in vocabulary}


def _words(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _literal(value, schema: str) -> Column:
    """Nested data as one literal (constant-folded by the optimizer)."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def license_scan(docs: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES, *,
                 min_score: float = 0.7) -> DataFrame:
    """The input's columns plus ``n_words``, ``base`` (struct<start, label> of every place of a base phrase,
    by start) and ``found`` (struct<label, start, score> of every template place with at least
    ``min_score`` of its words agreeing and its key phrase whole)."""
    every = [(t, False) for t in templates] + [(Template(label, phrase, phrase), True) for phrase, label in BASE]
    key_words = sorted({w for t, _ in every for w in t.key.split()})
    df = document_frequency(docs, text_col, key_words)
    postings: dict[str, list] = {}
    table = []
    for number, (t, base) in enumerate(every):
        key = t.key.split()
        rare = sorted(dict.fromkeys(key), key=lambda w: (df[w], w))[:INDEX_WORDS]
        for w in rare:
            postings.setdefault(w, []).append({"t": number, "k": t.key_at + key.index(w)})
        table.append({"label": t.label, "base": base, "words": t.words, "n": len(t.words), "key_at": t.key_at,
                      "key_n": len(key), "rare": len(rare)})
    indexed = sorted(postings)
    index = _literal(postings, "map<string,array<struct<t:int,k:int>>>")
    known = _literal(table, "array<struct<label:string,base:boolean,words:array<string>,n:int,key_at:int,key_n:int,rare:int>>")

    def scan(words: Column) -> Column:
        hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                        lambda h: h["w"].isin(indexed))
        starts = F.array_sort(F.flatten(F.transform(hits, lambda h: F.transform(
            index[h["w"]], lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["k"]).alias("s"))))))

        def stands(x: Column, t: Column, k: Column) -> Column:
            return F.coalesce(F.get(words, x["s"] + k) == F.get(t["words"], k), F.lit(False))

        def score(x: Column, t: Column) -> Column:
            key = F.forall(F.sequence(t["key_at"], t["key_at"] + t["key_n"] - 1), lambda k: stands(x, t, k))
            agree = F.aggregate(F.sequence(F.lit(0), t["n"] - 1), F.lit(0), lambda n, k: n + stands(x, t, k).cast("int"))
            return F.when(key, agree / t["n"].cast("double")).otherwise(0.0)

        def places(proposed: Column) -> Column:
            # both indexed words of a template propose the same start: neighbours in the sorted array
            agreed = F.filter(proposed, lambda x, j: (known[x["t"]]["rare"] == 1) | F.coalesce(F.get(proposed, j + 1) == x, F.lit(False)))
            scored = F.transform(agreed, lambda x: F.struct(
                known[x["t"]]["label"].alias("label"), x["s"].cast("long").alias("start"), score(x, known[x["t"]]).alias("score"),
                known[x["t"]]["base"].alias("base")))
            return F.filter(scored, lambda x: x["score"] >= min_score)

        def split(found: Column) -> Column:
            return F.struct(
                F.array_sort(F.transform(F.filter(found, lambda x: x["base"]), lambda x: F.struct(x["start"].alias("start"), x["label"].alias("label")))).alias("base"),
                F.transform(F.filter(found, lambda x: ~x["base"]), lambda x: F.struct(x["label"].alias("label"), x["start"].alias("start"), x["score"].alias("score"))).alias("found"))

        none = F.struct(F.array().cast("array<struct<start:bigint,label:string>>").alias("base"),
                        F.array().cast("array<struct<label:string,start:bigint,score:double>>").alias("found"))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.when(F.arrays_overlap(words, _words(indexed)), let(let(starts, places), split)).otherwise(none).alias("at"))

    out = docs.withColumn("__scan", F.explode(F.array(let(words_of(F.col(text_col)), scan))))
    return (out.withColumn("n_words", F.col("__scan.n_words")).withColumn("base", F.col("__scan.at.base"))
            .withColumn("found", F.col("__scan.at.found")).drop("__scan"))


def license_rows(docs: DataFrame) -> DataFrame:
    """One row per document; ``score`` is the best agreement of a template (1 for a base phrase alone
    is not given: 0 without a template)."""
    scanned = license_scan(docs.select("doc_id", "text"))
    base, found = F.col("base"), F.col("found")
    base_labels = F.transform(base, lambda x: x["label"])
    own = F.transform(found, lambda x: x["label"])
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.get(base, F.lit(0))["start"].alias("first_word"), F.get(base, F.size(base) - 1)["start"].alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, own))), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform(found, lambda x: x["score"])), F.lit(0.0)).alias("score"))
