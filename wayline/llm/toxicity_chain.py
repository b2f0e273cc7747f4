"""Toxicity categories by a chain of linear models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import log, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from wayline.llm.common import check_kept
from wayline.operators.ordering import top_n_per_group
from wayline.session import materialize

#: Labelled rows that train the chain: a seeded sample, at most so many of each combination of labels.
MAX_PER_CLASS = 6_000
#: Terms that one model may weigh: those most associated with its category, at most so many.
MAX_TERMS = 200
FOLDS = 5
#: The folds choose a penalty on squared weights, then the share of the terms that may owe their association to chance.
PENALTIES = (0.1, 1.0, 10.0)
FALSE_DISCOVERIES = (0.05, 0.5, float("inf"))
_BLOCK = 2_048
_STARTS = (4, 5, 6, 7)
_EDGE = 1e-6
_FURTHEST = log((1 - _EDGE) / _EDGE)


def terms(text: Column) -> Column:
    """Distinct words (runs of letters and digits, lower-cased), beginnings of longer words, runs of signs, and how often words repeat.

    The last is one term: how many times, in powers of two, there are more words than different ones.
    """
    text = F.lower(F.coalesce(text, F.lit("")))
    all_words = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    words = F.array_distinct(all_words)
    starts = [
        F.transform(F.filter(words, lambda w, n=n: F.length(w) > n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*")))
        for n in _STARTS
    ]
    signs = F.filter(F.array_distinct(F.split(text, r"[\p{L}\p{N}\s]+")), lambda s: s != "")
    repeats = F.floor(F.log2(F.try_divide(F.size(all_words), F.size(words))))
    repeats = F.when(repeats > 0, F.array(F.concat(F.lit(" repeats "), repeats.cast("string")))).otherwise(F.array().cast("array<string>"))
    return F.concat(words, *starts, signs, repeats)


def training_sample(labels: DataFrame, id_col: str, categories: dict[str, str], seed: int, cap: int = MAX_PER_CLASS) -> DataFrame:
    """`id`, one 0/1 column per category, `fold` and `weight`: `cap` ids of each combination of labels, all if it has fewer.

    The ids are those with the smallest seeded hash. Most of the others go by a
    border that is wide enough, so the ranking meets few rows. `weight` is how
    many labelled ids of its combination each stands for.

    Rows with a null id or a null label are left out. An id labelled more than
    once has a category if any of its rows has.
    """
    rows = labels.select(labels[id_col].cast("long").alias("id"), *[F.expr(c).cast("int").alias(n) for n, c in categories.items()]).dropna()
    rows = rows.groupBy("id").agg(*[F.max(n).alias(n) for n in categories])
    share = weight = F.lit(1.0)
    for r in rows.groupBy(*categories).count().collect():  # one row per combination of labels
        same = reduce(lambda a, b: a & b, [F.col(c) == r[c] for c in categories])
        share = F.when(same, F.lit(min(1.0, (cap + 10 * sqrt(cap) + 20) / r["count"]))).otherwise(share)
        weight = F.when(same, F.lit(max(1.0, r["count"] / cap))).otherwise(weight)
    rows = rows.withColumn("draw", F.xxhash64(F.lit(seed), "id")).filter(F.pmod("draw", F.lit(1 << 30)) < share * float(1 << 30))
    rows = top_n_per_group(rows, list(categories), [F.pmod("draw", F.lit(1 << 30)), F.col("id")], cap)
    fold = F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(FOLDS)).cast("int")
    return rows.select("id", *categories, fold.alias("fold"), weight.alias("weight"))


def association(hits: np.ndarray, df: np.ndarray, share: float) -> np.ndarray:
    """Bound on the log probability that so many of a term's rows have a category by chance; 0 where fewer have it than expected."""
    rate = hits / np.maximum(df, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        distance = np.where(rate > 0, rate * np.log(rate / share), 0) + np.where(rate < 1, (1 - rate) * np.log((1 - rate) / (1 - share)), 0)
    return np.where(rate > share, -df * distance, 0.0)


def discoveries(log_p: np.ndarray, tests: int, rate: float) -> np.ndarray:
    """Which of `tests` tests are significant at a false discovery rate; the tests not given have larger probabilities."""
    order = np.argsort(log_p, kind="stable")
    fits = log_p[order] <= np.log(rate * np.arange(1, len(order) + 1) / max(tests, 1))
    chosen = np.zeros(len(log_p), bool)
    if fits.any():
        chosen[order[: np.flatnonzero(fits)[-1] + 1]] = True
    return chosen


def fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic model by Newton steps; the intercept bears no penalty."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float32)
    beta, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-9
    share = min(max(np.average(y, weights=weight), _EDGE), 1 - _EDGE)
    beta[-1] = np.log(share / (1 - share))

    def odds(b: np.ndarray) -> np.ndarray:
        return np.concatenate([x[i : i + _BLOCK].astype(float) @ b for i in range(0, len(x), _BLOCK)])

    def loss(b: np.ndarray) -> float:
        z = odds(b)
        return float(weight @ (np.logaddexp(0, z) - y * z) + 0.5 * ridge @ (b * b))

    now = loss(beta)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(odds(beta), -500, 500)))
        gradient, curvature = ridge * beta, np.diag(ridge + 1e-9)
        for i in range(0, len(x), _BLOCK):
            part, slope, bend = x[i : i + _BLOCK], (weight * (p - y))[i : i + _BLOCK], (weight * p * (1 - p))[i : i + _BLOCK]
            gradient = gradient + part.astype(float).T @ slope
            # The curvature only guides the step, so single precision will do.
            curvature = curvature + (part * bend[:, None].astype(np.float32)).T @ part
        step = np.linalg.solve(curvature, gradient)
        size = 1.0
        while loss(beta - size * step) > now and size > 1e-6:
            size /= 2
        beta = beta - size * step
        before, now = now, loss(beta)
        if before - now < 1e-6 * (1 + abs(now)):
            break
    return beta[:-1], float(beta[-1])


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, _EDGE, 1 - _EDGE)
    return np.log(p / (1 - p))


@dataclass(frozen=True)
class LinkModel:
    """One category's model: weights of terms and of the log odds of earlier categories; above `threshold` it is predicted."""

    terms: tuple[str, ...]
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float
    threshold: float


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Where probabilities of rows not learnt from err least; the middle of the best range.

    Nothing is predicted below an even chance where that errs no more, so a
    model that knows nothing but a small share predicts none.
    """
    order = np.argsort(-p, kind="stable")
    values, y, weight = p[order], y[order], weight[order]
    errors = np.concatenate([[weight @ y], weight @ y + np.cumsum(np.where(y == 1, -weight, weight))])
    # Only between different probabilities can a border lie.
    cut = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))
    best = cut[np.flatnonzero(errors[cut] <= errors[cut].min() + 1e-9)[0]]
    high = values[best - 1] if best else 1.0
    low = values[best] if best < len(values) else 0.0
    return float((high + low) / 2)


class Chain:
    """Categories in order, each with the model of its own terms and of the probabilities before it."""

    def __init__(self, categories: Sequence[str], models: Sequence[LinkModel]):
        self.categories, self.models = tuple(categories), tuple(models)

    @property
    def vocabulary(self) -> list[str]:
        return list(dict.fromkeys(t for m in self.models for t in m.terms))

    def known(self, text: Column) -> Column:
        """The terms of a text that any model weighs.

        By far the dearest step. The number of the row in it, always positive,
        keeps the optimizer from writing the step out wherever a category or a
        filter on one refers to it, so it is taken once a row.
        """
        words = self.vocabulary
        found = F.array_intersect(F.array(*map(F.lit, words)), terms(text)) if words else F.array().cast("array<string>")
        return F.when(F.monotonically_increasing_id() >= 0, found)

    def predict(self, rows: DataFrame) -> DataFrame:
        """Adds `p_<category>` for each category to rows with a column `_known`."""
        for k, (name, model) in enumerate(zip(self.categories, self.models)):
            z = F.lit(model.intercept)
            if model.terms:
                weights = F.create_map(*[F.lit(v) for t, w in zip(model.terms, model.weights.tolist()) for v in (t, w)])
                z = F.aggregate("_known", z, lambda total, t: total + F.coalesce(F.try_element_at(weights, t), F.lit(0.0)))
            for earlier, w in zip(self.categories[:k], model.earlier.tolist()):
                z = z + F.least(F.greatest(F.col(f"_z_{earlier}"), F.lit(-_FURTHEST)), F.lit(_FURTHEST)) * w
            rows = rows.withColumn(f"_z_{name}", z).withColumn(f"p_{name}", 1 / (1 + F.exp(-F.col(f"_z_{name}"))))
        return rows


def _share_model(share: float, k: int) -> LinkModel:
    """What is known of a category that all labelled rows have, or none, or that there are no labels for."""
    return LinkModel((), np.zeros(0), np.zeros(k), float("inf") if share else float("-inf"), 0.5)


@dataclass
class Training:
    """The sampled rows: labels, folds, weights, and which candidate terms each has."""

    names: list[str]
    tests: int
    words: list[str]
    present: np.ndarray
    labels: np.ndarray
    fold: np.ndarray
    weight: np.ndarray


def gather(train: DataFrame, categories: Sequence[str]) -> Training:
    """Candidate terms of each category, and the bounded sample as one array."""
    counts = train.select(F.explode(F.array_distinct("terms")).alias("term"), *categories).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), *[F.sum(c).alias(c) for c in categories]
    ).filter("df >= 3")
    counts = materialize(counts, "toxicity-terms")
    totals = train.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    words: dict[str, None] = {}
    for c in categories:
        share = (totals[c] or 0) / (totals["n"] or 1)
        if 0 < share < 1:
            df, hits = F.col("df").cast("double"), F.col(c).cast("double")
            rate = hits / df
            distance = rate * F.log(rate / share) + F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - share))).otherwise(0.0)
            likely = counts.filter(rate > share).orderBy((df * distance).desc(), "term").limit(2 * MAX_TERMS)
            words.update(dict.fromkeys(r.term for r in likely.select("term").collect()))
    listed = list(words)
    known = F.array_intersect(F.array(*map(F.lit, listed)), F.col("terms")) if listed else F.array().cast("array<string>")
    # The sample is bounded by MAX_PER_CLASS and each row by the candidates.
    rows = train.select("id", *categories, "fold", "weight", known.alias("known")).orderBy("id").collect()
    at = {t: i for i, t in enumerate(listed)}
    present = np.zeros((len(rows), len(listed)), bool)
    for i, r in enumerate(rows):
        present[i, [at[t] for t in r.known]] = True
    labels = np.array([[r[c] for c in categories] for r in rows], float).reshape(len(rows), len(categories))
    return Training(list(categories), counts.count(), listed, present, labels, np.array([r.fold for r in rows]), np.array([r.weight for r in rows], float))


def choose_terms(t: Training, k: int, rows: np.ndarray, rate: float) -> np.ndarray:
    """The candidates that the given rows associate with a category, at a false discovery rate, the strongest first."""
    y, present = t.labels[rows, k], t.present[rows]
    share = y.mean() if len(y) else 0.0
    if not 0 < share < 1:
        return np.zeros(0, int)
    log_p = association(y @ present, present.sum(axis=0), share)
    chosen = np.flatnonzero(discoveries(log_p, t.tests, rate) & (log_p < 0))
    return chosen[np.argsort(log_p[chosen], kind="stable")][:MAX_TERMS]


def _fitted(t: Training, k: int, rows: np.ndarray, before: np.ndarray, penalty: float, rate: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Terms, weights (of the terms, then of earlier log odds) and intercept learnt from some rows."""
    at = choose_terms(t, k, rows, rate)
    x = np.column_stack([t.present[rows][:, at], before[rows]])
    return at, *fit_linear(x, t.labels[rows, k], t.weight[rows], penalty)


def held_out(t: Training, k: int, before: np.ndarray, penalty: float, rate: float) -> np.ndarray:
    """For each row the probability of category k by a model that has not seen its fold."""
    y, p = t.labels[:, k], np.zeros(len(t.labels))
    for fold in range(FOLDS):
        held, rest = t.fold == fold, np.flatnonzero(t.fold != fold)
        if 0 < y[rest].sum() < len(rest):
            at, w, b = _fitted(t, k, rest, before, penalty, rate)
            z = np.column_stack([t.present[held][:, at], before[held]]) @ w + b
            p[held] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        else:
            p[held] = y[rest].mean() if len(rest) else y.mean()
    return p


def fit_link(t: Training, k: int, before: np.ndarray) -> tuple[LinkModel, np.ndarray]:
    """The model of category k, and for each row the probability by a model that has not seen its fold.

    The likelihood of these probabilities chooses the penalty and then how
    sure terms must be, and they set the threshold.
    """
    y = t.labels[:, k]
    share = y.mean() if len(y) else 0.0
    if not 0 < share < 1:
        return _share_model(share, k), np.full(len(y), share)

    def tried(penalty: float, rate: float) -> tuple[float, float, float, np.ndarray]:
        p = held_out(t, k, before, penalty, rate)
        clipped = np.clip(p, _EDGE, 1 - _EDGE)
        return float(-(t.weight @ np.where(y == 1, np.log(clipped), np.log(1 - clipped)))), penalty, rate, p

    first = min((tried(c, FALSE_DISCOVERIES[0]) for c in PENALTIES), key=lambda f: f[:3])
    _, penalty, rate, p = min([first, *(tried(first[1], r) for r in FALSE_DISCOVERIES[1:])], key=lambda f: f[:3])
    at, w, b = _fitted(t, k, np.arange(len(y)), before, penalty, rate)
    model = LinkModel(tuple(t.words[i] for i in at), w[: len(at)], w[len(at) :], b, best_threshold(p, y, t.weight))
    return model, p


def fit_chain(docs: DataFrame, sample: DataFrame, categories: Sequence[str], id_col: str, text_col: str) -> Chain:
    """Train on the sampled ids; a later model sees earlier log odds as models of the other folds predict them."""
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    # The sample's size is bounded by MAX_PER_CLASS, so it may go to every task.
    train = texts.join(F.broadcast(sample), "id").select("id", *categories, "fold", "weight", F.array_distinct(terms(F.col("text"))).alias("terms"))
    # One text for each id, the same at every run.
    train = train.groupBy("id", *categories, "fold", "weight").agg(F.min("terms").alias("terms"))
    t = gather(materialize(train, "toxicity-train"), categories)
    models, before = [], np.zeros((len(t.labels), 0))
    for k in range(len(categories)):
        model, p = fit_link(t, k, before)
        models.append(model)
        before = np.column_stack([before, logit(p)])
    return Chain(categories, models)


def toxicity(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text",
    seed: int = 5, keep: tuple[str, ...] = (),
) -> DataFrame:
    """`id`, `p_<category>` and `is_<category>` per category, and the columns named in `keep`, for every document.

    `categories` names 0/1 SQL expressions over `labels`, in chain order. A
    category without a term beyond chance answers with its share among the
    labels. Null and empty texts have no terms; texts are read whole, whatever
    their length; null ids are unlabelled; repeated rows get equal
    probabilities, and of texts that share a labelled id one is learnt from; empty tables give
    empty results; without labels every probability is 0, and with one class only it is that class's share.
    Columns of `docs` not named in `keep` are ignored; a kept column must not have the name of a result column.
    """
    names = list(categories)
    check_kept(keep, "id", *[f"{p}_{c}" for c in names for p in ("p", "is")])
    sample = materialize(training_sample(labels, id_col, categories, seed), "toxicity-sample")
    chain = fit_chain(docs, sample, names, id_col, text_col)
    rows = docs.select(docs[id_col].alias("id"), *[docs[c].alias(f"_keep_{c}") for c in keep], chain.known(docs[text_col]).alias("_known"))
    scored = chain.predict(rows)
    return scored.select(
        "id", *[f"p_{c}" for c in names],
        *[(F.col(f"p_{c}") >= F.lit(m.threshold)).alias(f"is_{c}") for c, m in zip(names, chain.models)],
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
    )
