"""Quality classifier by co-training.

Two views of a document: what its text is like (shares of capitals, symbols, digits, sentence marks, repeated
words and lines, word length) and what its metadata say (language, source, stored length). A logistic model per view is
fitted on labelled documents. In every round each model labels the unlabelled documents that it is surest of, in the
proportion of the labels, and hands them to the other model, which is fitted again with them. The last models are
calibrated on held-out labelled documents, their calibrated log odds are combined by a third logistic fit, and all
documents are scored by the combination.

Features of all whole texts are computed by Spark in one pass and stored with the labels. The driver sees at most
``max_labelled`` labelled feature rows (a documented bound; those with a small hash of their id, so the choice does not
depend on partitions) and never an unlabelled one. A round reads the whole feature table: one pass counts the margins of
all documents that are still unlabelled (in steps of 1 / ``STEPS``), from which the margins follow beyond which the surest
``share`` of them lie; then each Newton step (a shorter one where it would make the fit worse) is one pass that sums gradient and Hessian of all pseudo-labelled
documents per task, added up by Spark. So the number of exchanged documents grows with the corpus. Together the
pseudo-labels of a view weigh ``trust`` times its labelled documents at any size. Which documents have been handed over
follows from the earlier rounds' models, so no state is kept: a lost task is run again from the stored features.

Scoring is a DataFrame expression over the stored features. The cut is the held-out quantile that keeps ``keep`` of the
good documents, 0.5 at most.

Defined results: a null text is an empty text; null metadata are a value of their own; several labels of one
document count by majority, ties as good; labels without quality or document are ignored; without labels of both
classes there is no model: the score is null and every document is kept; repeated rows each get their own
score; an empty table gives an empty result; extra columns are ignored by ``quality_scores`` and kept by
``keep_good``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, map_arrow, stored

BUCKETS = 16  # hashed values of a metadata column
STEPS = 100  # steps of a margin of 1 in which margins are counted; margins beyond MOST count as MOST
MOST = 40
SURE = 1.0  # a model is not sure of a document below this margin
VIEWS = ("text_view", "meta_view")


def text_features(text: Column) -> dict[str, Column]:
    words = F.array_remove(F.split(text, r"\s+"), "")
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"\S"))
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    chars = F.greatest(F.char_length(text), F.lit(1)).cast("double")

    def share(pattern: str, of: Column) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / of

    return {
        "capitals": share(r"\p{Lu}{2,}", n),
        "symbols": F.log1p(20 * share(r"[#*$%&<>|=_~^@{}]+", n)),
        "shouts": F.log1p(20 * share(r"[!?]{2,}", n)),
        "digits": share(r"[0-9]+", n),
        "sentences": F.log1p(10 * share(r"[.!?]+(?=\s|$)", n)),
        "distinct": F.log(F.greatest(F.size(F.array_distinct(words)), F.lit(1)) + 1.0) / F.log(n + 1.0),
        "word_length": F.log(chars / n),
        "lines": 1.0 - F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "stock": F.lower(text).rlike("all rights reserved|cookie|privacy policy|terms of (use|service)|click here")
        .cast("double"),
        "length": F.log(n),
    }


def meta_features(docs: DataFrame) -> dict[str, Column]:
    out = {}
    for name in ("lang", "source"):
        bucket = (F.pmod(F.xxhash64(F.coalesce(F.col(name).cast("string"), F.lit("\x00null"))), F.lit(BUCKETS))
                  if name in docs.columns else F.lit(0))
        for k in range(BUCKETS):
            out[f"{name}_{k}"] = (bucket == k).cast("double")
    size = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    out["no_size"] = size.isNull().cast("double")
    out["size"] = F.log1p(F.greatest(F.coalesce(size, F.lit(0.0)), F.lit(0.0)))
    out["size_2"] = out["size"] * out["size"] / 10
    return out


def feature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` and one array per view."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"), F.array(*text_features(text).values()).alias("text_view"),
        F.array(*meta_features(docs).values()).alias("meta_view"))


def labelled_features(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      label_col: str = "quality") -> DataFrame:
    """The feature table with ``y`` (1 good, 0 bad, null unlabelled), stored."""
    votes = (labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").alias("id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y")))
    return stored(feature_table(docs, id_col, text_col).join(votes, "id", "left"), "quality-features")


@dataclass
class View:
    """A calibrated logistic model over one view."""
    mean: list[float]
    scale: list[float]
    weights: list[float]
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def column(self, view: str) -> Column:
        """Calibrated log odds as a DataFrame expression."""
        total = F.lit(float(self.bias))
        for k, (w, m, s) in enumerate(zip(self.weights, self.mean, self.scale, strict=True)):
            total = total + (F.get(view, F.lit(k)) - F.lit(float(m))) * F.lit(float(w / s))
        return total * F.lit(float(self.slope)) + F.lit(float(self.shift))


def logistic(x, y, ridge: float = 1.0, rounds: int = 30):
    """Ridge logistic regression by Newton steps on a matrix of the driver."""
    import numpy as np

    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(rounds):
        w, b, size = newton_step(w, b, newton_sums(x, y, w, b), ridge)
        if size < 1e-6:
            break
    return w, b


@dataclass
class CoTrained:
    text: View
    meta: View
    weights: tuple[float, float]
    bias: float
    cut: float
    exchanged: int

    def score(self) -> Column:
        odds = (self.text.column("text_view") * F.lit(float(self.weights[0]))
                + self.meta.column("meta_view") * F.lit(float(self.weights[1])) + F.lit(float(self.bias)))
        return 1 / (1 + F.exp(-odds))


@dataclass
class Round:
    """The models of a round (per view: weights and bias over standardised features) and, per view, the margins below which,
    and from which on, it hands documents over."""
    models: list
    low: list[float]
    high: list[float]


def handed_over(views, rounds: list[Round]):
    """For unlabelled documents (standardised features of both views): which are still nobody's, and per view the label that
    the other view gave it (NaN: none)."""
    import numpy as np

    free = np.ones(len(views[0]), bool)
    given = [np.full(len(free), np.nan) for _ in views]
    for step in rounds:
        taken = np.zeros(len(free), bool)
        for v in (0, 1):
            w, b = step.models[v]
            margin = views[v] @ w + b
            for chosen, label in ((free & (margin < step.low[v]), 0.0), (free & (margin >= step.high[v]), 1.0)):
                given[1 - v][chosen] = label
                taken |= chosen
        free &= ~taken
    return free, given


def newton_sums(x, y, w, b):
    """The log likelihood at (w, b), its gradient and Hessian, summed over rows, as one vector; the number of rows first."""
    import numpy as np

    a = np.c_[x, np.ones(len(x))]
    z = a @ np.r_[w, b]
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return np.concatenate([[len(y), (y * z - np.logaddexp(0, z)).sum()], a.T @ (y - p), ((a * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ a).ravel()])


def newton_step(w, b, sums, ridge: float = 1.0):
    """The next (w, b) and the size of the step; the bias is not shrunk."""
    import numpy as np

    at = np.r_[w, b]
    shrink = np.full(len(at), ridge)
    shrink[-1] = 1e-6
    gradient = sums[2:2 + len(at)] - shrink * at
    hessian = sums[2 + len(at):].reshape(len(at), len(at)) + np.diag(shrink)
    step = np.linalg.solve(hessian, gradient)
    step *= min(1.0, 5 / max(np.abs(step).max(), 1e-12))
    at = at + step
    return at[:-1], at[-1], np.abs(step).max()


def _sweep(features: DataFrame, norms: list, work) -> dict[int, float]:
    """Sums over all unlabelled documents: ``work`` turns the standardised views of a batch into a vector of a fixed length;
    the vectors are summed per task, then by Spark by their index."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            views = [(np.asarray(batch.column(v).flatten()).reshape(batch.num_rows, -1) - m) / s for v, (m, s) in enumerate(norms)]
            sums = work(views)
            total = sums if total is None else total + sums
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.float64())], names=["at", "value"])

    rows = features.filter("y is null").select(*VIEWS)
    return {r["at"]: r["value"] for r in map_arrow(rows, run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()}


def margin_counts(views, rounds: list[Round], models: list):
    """How many of the documents that are nobody's have each margin, for both views."""
    import numpy as np

    free, _ = handed_over(views, rounds)
    width = 2 * MOST * STEPS + 1
    out = np.zeros(2 * width)
    for v, (w, b) in enumerate(models):
        at = np.clip(np.floor((views[v][free] @ w + b) * STEPS), -MOST * STEPS, MOST * STEPS).astype(np.int64) + MOST * STEPS
        out[v * width:(v + 1) * width] += np.bincount(at, minlength=width)
    return out


def sure_margins(counts, n_bad: int, n_good: int) -> tuple[float, float]:
    """The margin below which the ``n_bad`` lowest of the counted documents lie, and that from which on the ``n_good`` highest
    do: all documents of the last step that is needed go along. Nothing within SURE of zero."""
    import numpy as np

    edges = np.arange(-MOST * STEPS, MOST * STEPS + 2) / STEPS
    up, down = np.cumsum(counts), np.cumsum(counts[::-1])
    low = edges[min(int(np.searchsorted(up, n_bad)), len(counts) - 1) + 1] if n_bad and up[-1] else -np.inf
    high = edges[::-1][min(int(np.searchsorted(down, n_good)), len(counts) - 1) + 1] if n_good and up[-1] else np.inf
    return min(low, -SURE), max(high, SURE)


def _exchange(features: DataFrame, norms: list, models: list, train: list, y, good: float, unlabelled: int, rounds: int,
              share: float, trust: float, steps: int) -> tuple[list, int]:
    """The models after the rounds, and the number of pseudo-labels given."""
    import numpy as np

    done: list[Round] = []
    width, exchanged = 2 * MOST * STEPS + 1, 0
    n = share * unlabelled
    for k in range(rounds if unlabelled else 0):
        now = list(models)
        counted = _sweep(features, norms, lambda views, now=now: margin_counts(views, done, now))
        counts = np.zeros(2 * width)
        counts[list(counted)] = list(counted.values())
        limits = [sure_margins(counts[v * width:(v + 1) * width], round(n * (1 - good)), round(n * good)) for v in (0, 1)]
        done.append(Round(now, [lo for lo, _ in limits], [hi for _, hi in limits]))

        def at_points(points):
            """Per view: the objective and the sums at a point, labelled and pseudo-labelled documents together."""
            def sums(views):
                _, given = handed_over(views, done)
                return np.concatenate([newton_sums(x[~np.isnan(g)], g[~np.isnan(g)], *m)
                                       for x, g, m in zip(views, given, points, strict=True)])
            sizes = [2 + (x.shape[1] + 1) * (x.shape[1] + 2) for x in train]
            total = np.zeros(sum(sizes))
            found = _sweep(features, norms, sums)
            total[list(found)] = list(found.values())
            out = []
            for v, pseudo in enumerate(np.split(total, [sizes[0]])):
                weight = trust * min(1.0, len(y) / max(pseudo[0], 1.0))
                both = newton_sums(train[v], y, *points[v]) + weight * pseudo
                out.append((both[1] - 0.5 * float(points[v][0] @ points[v][0]), both, pseudo[0]))
            return out

        best = at_points(models)
        exchanged = int(round(sum(n_given for _, _, n_given in best)))
        part = [1.0, 1.0]  # of the Newton step that is tried: less after a step that made it worse
        for _ in range(steps if k < rounds - 1 else 4 * steps):
            tried, moved = [], 0.0
            for v in (0, 1):
                (w, b), (w1, b1, size) = models[v], newton_step(*models[v], best[v][1])
                tried.append((w + part[v] * (w1 - w), b + part[v] * (b1 - b)))
                moved = max(moved, size * part[v])
            if moved < 1e-3:
                break
            for v, got in enumerate(at_points(tried)):
                if got[0] >= best[v][0]:
                    models[v], best[v], part[v] = tried[v], got, min(1.0, 2 * part[v])
                else:
                    part[v] /= 4
    return models, exchanged


def fit(features: DataFrame, *, max_labelled: int = 20_000, rounds: int = 5, share: float = 0.05, trust: float = 0.3,
        steps: int = 3, keep: float = 0.995) -> CoTrained | None:
    """The model for a table of features with labels (``labelled_features``); None without labels of both classes. Every fourth
    labelled document is held out. ``share`` of the unlabelled documents per round and view is exchanged at most, and those of
    an equal margin as the last."""
    import numpy as np

    n = features.agg(F.count("y").alias("labelled"), F.count(F.lit(1)).alias("all")).first()
    if not n["labelled"]:
        return None
    rows = hash_sample(features.filter("y is not null"), n["labelled"], max_labelled, "id").collect()
    # an order of their own, whatever the partitions
    rows = sorted(rows, key=lambda r: (zlib.crc32(str(r["id"]).encode()), r["id"], r["text_view"], r["meta_view"]))
    views = [np.array([r[v] for r in rows], float).reshape(len(rows), -1) for v in VIEWS]
    y = np.array([r["y"] for r in rows], float)
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[~held].tolist())) < 2 or len(set(y[held].tolist())) < 2:
        return None
    norms = [(v[~held].mean(0), np.where(v[~held].std(0) > 1e-9, v[~held].std(0), 1.0)) for v in views]
    views = [(x - m) / s for x, (m, s) in zip(views, norms, strict=True)]
    train = [x[~held] for x in views]
    models = [logistic(x, y[~held]) for x in train]
    models, exchanged = _exchange(features, norms, models, train, y[~held], y[~held].mean(), n["all"] - n["labelled"], rounds,
                                  share, trust, steps)
    odds, fitted = [], []
    for (w, b), x, (m, s) in zip(models, views, norms, strict=True):
        margin = x[held] @ w + b
        slope, shift = logistic(margin[:, None], y[held], ridge=0.1)
        fitted.append(View(list(m), list(s), list(w), float(b), float(max(slope[0], 0.0)), float(shift)))
        odds.append(margin * fitted[-1].slope + fitted[-1].shift)
    both, bias = logistic(np.c_[odds[0], odds[1]], y[held], ridge=0.1)
    both = np.maximum(both, 0.0)  # a calibrated view never speaks against itself
    p = 1 / (1 + np.exp(-(odds[0] * both[0] + odds[1] * both[1] + bias)))
    cut = min(0.5, float(np.quantile(p[y[held] == 1], 1 - keep)))
    return CoTrained(*fitted, (float(both[0]), float(both[1])), float(bias), cut, exchanged)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", **parameters) -> DataFrame:
    """``id_col``, ``score`` (probability that the document is good), ``text_score``, ``meta_score`` (of each
    calibrated view) and ``kept``, one row per input row. ``parameters`` are those of ``fit``."""
    features = labelled_features(docs, labels, id_col, text_col, label_col)
    model = fit(features, **parameters)
    if model is None:
        none = F.lit(None).cast("double")
        scores = {"score": none, "text_score": none, "meta_score": none, "kept": F.lit(True)}
    else:
        score = model.score()
        scores = {"score": score, "text_score": 1 / (1 + F.exp(-model.text.column("text_view"))),
                  "meta_score": 1 / (1 + F.exp(-model.meta.column("meta_view"))),
                  "kept": score >= F.lit(model.cut)}
    return features.select(F.col("id").alias(id_col), *[c.alias(n) for n, c in scores.items()])


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", **parameters) -> DataFrame:
    """The rows that the classifier does not reject, all columns. The features are computed again beside the
    text, so no text is shuffled and rows that share an id are judged each by its own text."""
    model = fit(labelled_features(docs, labels, id_col, text_col, label_col), **parameters)
    if model is None:
        return docs
    text = F.coalesce(F.col(text_col), F.lit(""))
    viewed = docs.select("*", F.array(*text_features(text).values()).alias("text_view"),
                         F.array(*meta_features(docs).values()).alias("meta_view"))
    return viewed.filter(model.score() >= F.lit(model.cut)).select(*[viewed[f"`{c}`"] for c in docs.columns])


def quality_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document."""
    return quality_scores(docs, labels)
