import random

import numpy as np

from tests.llm.conftest import doc
from wardlens.llm import co_training as c

LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice("abcdefghij") + "".join(rng.choices("aeinorst", k=rng.randint(1, 7))) for _ in range(rng.randint(8, 60))]
        good = rng.random() < 0.8
        text = " ".join(words).capitalize() + "." if good else " ".join(w.upper() + "!!" for w in words)
        rows.append(doc(i, text, rng.choice(["en", "de"]), "s1" if good or rng.random() < 0.5 else "bad"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy_and_the_kept_good(make):
    rows, labels = corpus(800)
    scored = c.quality_rows(make(rows), make(labels[:400], LABELS)).collect()
    truth = dict((i, q) for i, q, _ in labels)
    held = [r for r in scored if r.doc_id >= 400]
    assert np.mean([r.kept == (truth[r.doc_id] == 1) for r in held]) > 0.97
    assert np.mean([r.kept for r in held if truth[r.doc_id]]) > 0.99
    assert all(0 <= r.score <= 1 and r.meta_score is not None for r in scored)
    kept = c.keep_good(make(rows), make(labels[:400], LABELS))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored if r.kept}


def plain(features, rounds=5, share=0.05, trust=0.3, steps=3, keep=0.995):
    """Co-training on whole arrays, by the definition."""
    import zlib
    rows = sorted(features, key=lambda r: (r.y is None, zlib.crc32(str(r.id).encode()), r.id or 0, r.text_view, r.meta_view))
    x = [np.array([r[v] for r in rows], float) for v in ("text_view", "meta_view")]
    n = sum(r.y is not None for r in rows)
    y, held = np.array([r.y for r in rows[:n]], float), np.arange(n) % 4 == 3
    for v in (0, 1):
        m, s = x[v][:n][~held].mean(0), x[v][:n][~held].std(0)
        x[v] = np.c_[(x[v] - m) / np.where(s > 1e-9, s, 1), np.ones(len(rows))]
    shrink = [np.r_[np.ones(a.shape[1] - 1), 1e-6] for a in x]

    def newton(v, w, parts):
        g, h, f = -shrink[v] * w, np.diag(shrink[v]), -0.5 * (w[:-1] ** 2).sum()
        for a, t, weight in parts:
            z = a @ w
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            f += weight * (t * z - np.logaddexp(0, z)).sum()
            g, h = g + weight * a.T @ (t - p), h + weight * (a.T * np.maximum(p * (1 - p), 1e-6)) @ a
        step = np.linalg.solve(h, g)
        return f, step * min(1, 5 / np.abs(step).max())
    train = [x[v][:n][~held] for v in (0, 1)]
    ws = [np.zeros(x[v].shape[1]) for v in (0, 1)]
    for v in (0, 1):
        for _ in range(30):
            ws[v] = ws[v] + newton(v, ws[v], [(train[v], y[~held], 1)])[1]
    pool, good = [a[n:] for a in x], y[~held].mean()
    owner, given, total = np.zeros(len(rows) - n, bool), [np.full(len(rows) - n, np.nan) for _ in x], 0
    for k in range(rounds):
        margins, taken = [np.clip(a @ w, -40, 40.005) for a, w in zip(pool, ws, strict=True)], owner.copy()
        for v in (0, 1):
            step = np.sort(np.floor(margins[v][~owner] * 100))
            n_bad, n_good = round(share * len(owner) * (1 - good)), round(share * len(owner) * good)
            low = min((step[min(n_bad, len(step)) - 1] + 1) / 100 if n_bad and len(step) else -np.inf, -1)
            high = max(step[::-1][min(n_good, len(step)) - 1] / 100 if n_good and len(step) else np.inf, 1)
            for rows_, label in ((~owner & (margins[v] < low), 0), (~owner & (margins[v] >= high), 1)):
                given[1 - v][rows_] = label
                taken |= rows_
        owner = taken
        parts = []
        for v in (0, 1):
            has = ~np.isnan(given[v])
            weight = trust * min(1, (~held).sum() / max(has.sum(), 1))
            parts.append([(train[v], y[~held], 1), (pool[v][has], given[v][has], weight)])
        part = [1, 1]
        for _ in range(steps if k < rounds - 1 else 4 * steps):
            old = [newton(v, ws[v], parts[v]) for v in (0, 1)]
            if max(part[v] * np.abs(old[v][1]).max() for v in (0, 1)) < 1e-3:
                break
            for v in (0, 1):
                new = ws[v] + part[v] * old[v][1]
                if newton(v, new, parts[v])[0] >= old[v][0]:
                    ws[v], part[v] = new, min(1, 2 * part[v])
                else:
                    part[v] /= 4
    return sum((~np.isnan(g)).sum() for g in given), [{r.id: m for r, m in zip(rows, a @ w, strict=True)} for a, w in zip(x, ws, strict=True)]


def logit(p):
    return np.log(p / (1 - p))


def test_rounds_equal_co_training_on_whole_arrays(make):
    rows, labels = corpus(900, seed=5)
    docs, given = make(rows, partitions=5), make(labels[:200], LABELS)
    features = c.labelled_features(docs, given)
    model = c.fit(features)
    exchanged, margins = plain(features.collect())
    assert model.exchanged == exchanged > 100
    for r in c.quality_rows(docs, given).collect():
        for view, score, m in ((model.text, r.text_score, margins[0]), (model.meta, r.meta_score, margins[1])):
            if 1e-9 < score < 1 - 1e-9:
                assert abs(logit(score) - (m[r.doc_id] * view.slope + view.shift)) < 1e-4


def test_the_exchange_grows_with_the_corpus(make):
    rows, labels = corpus(2500, seed=6)
    small, large = (c.fit(c.labelled_features(make(rows[:n], partitions=4), make(labels[:100], LABELS))) for n in (700, 2500))
    assert 3 < large.exchanged / small.exchanged < 5  # 2,400 and 600 unlabelled documents
    # neither the partitions nor copies of everything change the models much
    again = c.fit(c.labelled_features(make(rows, partitions=9), make(labels[:100], LABELS)))
    assert again.exchanged == large.exchanged and np.allclose(again.text.weights, large.text.weights)
    assert c.fit(c.labelled_features(make(rows[:700]), make([(i, 1, 0) for i in range(100)], LABELS))) is None


def test_margins_are_cut_at_the_surest():
    width = 2 * c.MOST * c.STEPS + 1
    counts = np.zeros(width)
    zero = c.MOST * c.STEPS
    counts[[zero - 500, zero - 300, zero + 150, zero + 400]] = (10, 5, 7, 3)
    assert c.sure_margins(counts, 10, 3) == (-4.99, 4.0)
    assert c.sure_margins(counts, 11, 4) == (-2.99, 1.5)
    assert c.sure_margins(counts, 99, 99) == (-1.0, 1.0)
    assert c.sure_margins(counts, 0, 0) == (-np.inf, np.inf)
    assert c.sure_margins(np.zeros(width), 5, 5) == (-np.inf, np.inf)


def test_no_labels_odd_labels_and_edge_rows(make):
    rows = [doc(1, None), doc(2, ""), doc(3, "x " * 50_000), doc(None, "Fine."), (5, "A b.", None, None, None), doc(1, None)]
    docs = make(rows)
    for labels in ([], [(1, None, 0), (None, 1, 0)], [(1, 1, 0), (2, 1, 1)]):
        got = c.quality_rows(docs, make(labels, LABELS)).collect()
        assert len(got) == len(rows) and all(r.kept and r.score is None for r in got)
        assert c.keep_good(docs, make(labels, LABELS)).count() == len(rows)
    many, labels = corpus(200)
    labels += [(0, 1 - labels[0][1], 0), (0, labels[0][1], 0), (1, None, None)]
    got = c.quality_rows(make(many + rows), make(labels, LABELS)).collect()
    assert len(got) == 206 and all(r.score is not None and r.kept is not None for r in got)
    assert c.quality_rows(make([]), make(labels, LABELS)).count() == 0
    bare = make([(1, "Some text.")], "doc_id bigint, text string")
    assert c.quality_rows(bare, make(labels, LABELS)).count() == 1
