"""Multinomial Naive Bayes as two aggregations and one broadcast join.

Several models (folds, source domains) are fitted together: each is a weight
column on the documents, 0 meaning "not in this training set". Term weights are
kept in fixed point (1e-9), so sums do not depend on the order in which Spark
adds them and scores are the same on any number of partitions.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .features import token_rows

SCALE = 1_000_000_000


def _fixed(x: Column) -> Column:
    return F.round(x * F.lit(float(SCALE)), 0).cast("bigint")


def fit(
    docs: DataFrame, weights: Mapping[str, Column], *, classes: Sequence[int] = (0, 1), label: str = "label",
    text: str = "text", alpha: float = 1.0, max_features: int = 20_000, min_len: int = 2,
) -> DataFrame:
    """Long model table (model, term, lp_<class>), at most ``max_features``
    terms per model: the most frequent in its training set, ties by term."""
    names = list(weights)
    weighted = docs.select(label, text, *[weights[m].cast("bigint").alias(f"_w_{m}") for m in names])
    rows = token_rows(weighted, text=text, keep=[label, *[f"_w_{m}" for m in names]], min_len=min_len)
    counts = rows.groupBy("term").agg(
        *[
            F.sum(F.when(F.col(label) == c, F.col(f"_w_{m}")).otherwise(0)).alias(f"_{m}_{c}")
            for m in names for c in classes
        ]
    )
    # One row per model and term. The models are split apart only after the
    # shuffle, so that all of them share one count of the tokens.
    cells = [
        F.struct(F.lit(m).alias("model"), *[F.col(f"_{m}_{c}").alias(f"n_{c}") for c in classes]) for m in names
    ]
    long = counts.select("term", F.explode(F.array(*cells)).alias("e")).select("term", "e.*")
    total = functools.reduce(lambda a, b: a + b, [F.col(f"n_{c}") for c in classes])
    whole = W.partitionBy(F.lit(1))  # at most max_features rows
    parts = []
    for m in names:
        top = long.where((F.col("model") == m) & (total > 0)).orderBy(total.desc(), "term").limit(max_features)
        parts.append(
            top.select(
                "model", "term",
                *[
                    F.ln((F.col(f"n_{c}") + alpha) / (F.sum(f"n_{c}").over(whole) + alpha * F.count("*").over(whole))).alias(f"lp_{c}")
                    for c in classes
                ],
            )
        )
    return functools.reduce(DataFrame.unionByName, parts)


def priors(docs: DataFrame, weights: Mapping[str, Column], *, classes: Sequence[int] = (0, 1), label: str = "label") -> DataFrame:
    """One row with ln(n_c / n) per model and class; NULL for an absent class."""
    w = docs.select(label, *[weights[m].cast("bigint").alias(f"_w_{m}") for m in weights])
    agg = w.agg(
        *[F.sum(F.when(F.col(label) == c, F.col(f"_w_{m}")).otherwise(0)).alias(f"n_{m}_{c}") for m in weights for c in classes],
        *[F.sum(f"_w_{m}").alias(f"n_{m}") for m in weights],
    )
    return agg.select(
        *[
            F.when(F.col(f"n_{m}_{c}") > 0, F.ln(F.col(f"n_{m}_{c}") / F.col(f"n_{m}"))).alias(f"prior_{m}_{c}")
            for m in weights for c in classes
        ]
    )


def score(
    docs: DataFrame, model: DataFrame, prior: DataFrame, models: Sequence[str], *, classes: Sequence[int] = (0, 1),
    id_col: str = "doc_id", text: str = "text", keep: Sequence[str] = (), min_len: int = 2,
) -> DataFrame:
    """Per document and model one column ``s_<model>_<class>``.

    The model table has a capped number of rows and is broadcast; the only
    shuffle carries one partial row per document. Tokens unknown to a model
    count nothing. A class absent from a training set scores NULL.
    """
    wide = model.groupBy("term").agg(
        *[
            F.max(F.when(F.col("model") == m, _fixed(F.col(f"lp_{c}")))).alias(f"_lp_{m}_{c}")
            for m in models for c in classes
        ]
    )
    rows = token_rows(docs, text=text, keep=[id_col], min_len=min_len, keep_empty=True)
    sums = rows.join(F.broadcast(wide), "term", "left").groupBy(id_col).agg(
        *[F.sum(F.coalesce(F.col(f"_lp_{m}_{c}"), F.lit(0))).alias(f"_s_{m}_{c}") for m in models for c in classes]
    )
    packed = prior.select(F.struct(*prior.columns).alias("p"))
    sums = sums.withColumn("_p", packed.scalar()).select(
        id_col,
        *[
            (F.col(f"_p.prior_{m}_{c}") + F.col(f"_s_{m}_{c}") / F.lit(float(SCALE))).alias(f"s_{m}_{c}")
            for m in models for c in classes
        ],
    )
    return sums.join(docs.select(id_col, *keep), id_col) if keep else sums


def predict(scored: DataFrame, model: str, classes: Sequence[int] = (0, 1)) -> tuple[Column, Column]:
    """(pred, prob of the last class). The first class wins a tie; an absent
    class never wins."""
    s = {c: F.col(f"s_{model}_{c}") for c in classes}
    pred, best = F.lit(classes[0]), s[classes[0]]
    for c in classes[1:]:
        better = s[c].isNotNull() & (best.isNull() | (s[c] > best))
        pred, best = F.when(better, F.lit(c)).otherwise(pred), F.when(better, s[c]).otherwise(best)
    top = best
    total = functools.reduce(lambda a, b: a + b, [F.coalesce(F.exp(s[c] - top), F.lit(0.0)) for c in classes])
    return pred, F.coalesce(F.exp(s[classes[-1]] - top), F.lit(0.0)) / total


def predict_long(scored: DataFrame, models: Sequence[str], keep: Sequence[str], *, classes: Sequence[int] = (0, 1), name: str = "model") -> DataFrame:
    """One row per document and model: keep columns, model, pred, prob."""
    items = []
    for m in models:
        pred, prob = predict(scored, m, classes)
        items.append(F.struct(F.lit(m).alias(name), pred.cast("int").alias("pred"), prob.alias("prob")))
    return scored.select(*keep, F.explode(F.array(*items)).alias("_m")).select(*keep, "_m.*")


def top_features(model: DataFrame, k: int = 10, *, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """(model, class, rank, term, logprob): heaviest terms per class."""
    long = model.select(
        "model", "term",
        F.explode(F.array(*[F.struct(F.lit(c).alias("class"), F.col(f"lp_{c}").alias("logprob")) for c in classes])).alias("e"),
    ).select("model", "term", "e.*")
    w = W.partitionBy("model", "class").orderBy(F.desc(F.round("logprob", 9)), "term")
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def fold_copies(docs: DataFrame, k: int = 5, *, id_col: str = "doc_id", label: str = "label", balance: bool = True, seed: int = 42) -> DataFrame:
    """(id, fold, _c0 .. _c<k-1>): how often each row is in the training part of
    each fold. The parts are balanced on their own; held-out rows are in none.
    """
    from ..session import stage
    from .balance import copies_to_majority
    from .splits import stratified_folds

    folded = stratified_folds(docs.select(id_col, label), k, id_col=id_col, label=label, seed=seed)
    if balance:
        # Balance every training part at once: a row appears once per fold it
        # trains in, and the copies are ranked inside (fold, label).
        train = folded.select(id_col, label, "fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_held"))
        train = train.where(F.col("fold") != F.col("_held"))
        copies = copies_to_majority(train, label=label, id_col=id_col, keys=["_held"], seed=seed)
        plan = copies.groupBy(id_col).agg(
            F.max("fold").alias("fold"),
            *[F.sum(F.when(F.col("_held") == i, F.col("copies")).otherwise(0)).alias(f"_c{i}") for i in range(k)],
        )
    else:
        plan = folded.select(id_col, "fold", *[(F.col("fold") != i).cast("bigint").alias(f"_c{i}") for i in range(k)])
    # Fit, priors and scores all need the plan; it is a few integers per row.
    return stage(plan, "fold-plan")


def cross_validate(
    docs: DataFrame, k: int = 5, *, id_col: str = "doc_id", label: str = "label", text: str = "text",
    alpha: float = 1.0, max_features: int = 20_000, balance: bool = True, seed: int = 42, keep: Sequence[str] = (),
) -> DataFrame:
    """Out-of-fold predictions of k models fitted in one job.

    The training part of each fold is balanced on its own; the held-out rows
    are never copied into it.
    """
    names = [f"f{i}" for i in range(k)]
    plan = fold_copies(docs, k, id_col=id_col, label=label, balance=balance, seed=seed)
    folded = docs.join(plan, id_col)
    weights = {n: F.col(f"_c{i}") for i, n in enumerate(names)}
    model = fit(folded, weights, label=label, text=text, alpha=alpha, max_features=max_features)
    prior = priors(folded, weights, label=label)
    scored = score(folded, model, prior, names, id_col=id_col, text=text, keep=[label, "fold", *keep])
    items = []
    for i, n in enumerate(names):
        pred, prob = predict(scored, n)
        items.append((i, pred, prob))
    p, q = F.lit(None).cast("int"), F.lit(None).cast("double")
    for i, pred, prob in items:
        p = F.when(F.col("fold") == i, pred).otherwise(p)
        q = F.when(F.col("fold") == i, prob).otherwise(q)
    return scored.select(id_col, "fold", label, *keep, p.cast("int").alias("pred"), q.alias("prob"))


def transfer_predictions(
    docs: DataFrame, domains: Sequence[str], *, domain: str = "domain", id_col: str = "doc_id", label: str = "label",
    text: str = "text", alpha: float = 1.0, max_features: int = 20_000,
) -> DataFrame:
    """Predictions of every source model on every target row, in one job."""
    names = {f"m{i}": d for i, d in enumerate(domains)}
    weights = {m: (F.col(domain) == d).cast("bigint") for m, d in names.items()}
    weights = {m: F.coalesce(w, F.lit(0)) for m, w in weights.items()}
    model = fit(docs, weights, label=label, text=text, alpha=alpha, max_features=max_features)
    prior = priors(docs, weights, label=label)
    scored = score(docs, model, prior, list(names), id_col=id_col, text=text, keep=[label, domain])
    long = predict_long(scored, list(names), [id_col, label, domain])
    source = F.coalesce(*[F.when(F.col("model") == m, F.lit(d)) for m, d in names.items()])
    return long.select(id_col, source.alias("source"), F.col(domain).alias("target"), label, "pred", "prob")
