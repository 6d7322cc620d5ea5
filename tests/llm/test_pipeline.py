import hashlib
import random

import pytest

import corpus_pipeline
from tests.llm.conftest import doc
from tests.llm.test_dart_minhash import brute
from wardlens.llm import decontaminate, registry

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture()
def tables(spark, tmp_path):
    rng = random.Random(11)

    def text(n):
        return " ".join(rng.choice("bcdfg") + "".join(rng.choices("aeiou", k=rng.randint(1, 8))) + str(rng.randrange(3000)).translate(
            str.maketrans("0123456789", "klmnprstvw")) for _ in range(n)).capitalize() + "."
    clean = [text(rng.randint(20, 90)) for _ in range(120)]
    shouts = [" ".join(w.upper() + "!!" for w in text(40).split()) for _ in range(30)]
    item = text(25)
    rows = [doc(i, t) for i, t in enumerate(clean + shouts)]
    rows += [doc(300, clean[3]), doc(301, clean[4].replace(".", " x.")), doc(302, clean[5] + " " + item + " " + clean[6]),
             doc(303, clean[7] + " " + text(30) + " password=0123456789abcdef " + text(30)), doc(304, None), doc(305, "")]
    labels = [(i, int(i < 120), 0) for i in range(0, 150, 2)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows


def test_stages_against_brute_force(spark, tables):
    sf_dir, rows = tables
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "tokens"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if k < 4:
            assert out.columns == columns
        out.write.parquet(f"{sf_dir}/out-{k}")
        docs = spark.read.parquet(f"{sf_dir}/out-{k}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        assert len(seen[name]) == docs.count()
    quality = seen["quality"]
    assert sum(i < 120 for i in quality) >= 118 and not any(120 <= i < 150 for i in quality)
    classes = brute([(i, r.text) for i, r in quality.items()])
    assert set(seen["near_dedup"]) == set(classes.values())
    words = [" ".join(decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {i for i, r in seen["near_dedup"].items() if words[0] not in " ".join(decontaminate.words_of(r.text))}
    assert set(seen["decontamination"]) == clean and 302 not in clean
    assert "password" not in seen["secrets"][303].text and seen["secrets"][303].n_chars == len(seen["secrets"][303].text)
    library = tokenizers.Tokenizer.from_file(registry.tokenizer_path())
    assert set(seen["tokens"]) == clean
    for i, r in seen["tokens"].items():
        ids = library.encode(seen["secrets"][i].text or "", add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_run_and_empty_documents(spark, tables, tmp_path):
    sf_dir, rows = tables
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_the_secrets_stage_fits_on_all_strings(spark, tmp_path):
    from wardlens.llm import secret_grammar
    rng = random.Random(6)

    def value(alphabet, k):
        return "".join(rng.choices(alphabet, k=k))
    rows = [doc(i, " ".join(f"{value('etaoinshr', 9)} token: {value('0123456789ABCDEFGHJKMNPQRSTVWXYZ', 20)}" for _ in range(10)))
            for i in range(130)]
    bare = [value("0123456789ABCDEFGHJKMNPQRSTVWXYZ", 20) for _ in range(40)]
    rows += [doc(1000 + i, f"understanding {b} information") for i, b in enumerate(bare)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    grammar = secret_grammar.infer(docs, "text", 1000, 0.4)
    assert sum(x.stops for x in grammar.credentials["assign"].states) == 1300
    assert sum(x.stops for x in grammar.others.states) > 1000
    got = {r.doc_id: r for r in corpus_pipeline.secrets(spark, docs, str(tmp_path)).collect()}
    assert sum(got[1000 + i].text == "understanding [REDACTED] information" for i in range(40)) >= 38
    assert all(r.n_chars == len(r.text) for r in got.values())
