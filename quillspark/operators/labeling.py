"""Weak supervision: rule votes, their statistics, and the voted label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import lexicons as lx
from ..functions.rules import Rule, default_rules, rule_then_score, weighted_vote


def apply_rules(df: DataFrame, rules: Mapping[str, Rule] | None = None, *, text: str = "text", prefix: str = "vote_") -> DataFrame:
    """One integer column per rule; a projection, no shuffle."""
    rules = rules or default_rules()
    return df.withColumns({f"{prefix}{n}": r(F.col(text)) for n, r in rules.items()})


def vote_columns(names: Sequence[str], prefix: str = "vote_") -> list[Column]:
    return [F.col(f"{prefix}{n}") for n in names]


def long_votes(votes: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep, rule_no, rule, vote): the label matrix in long form."""
    cells = F.array(
        *[F.struct(F.lit(i).alias("rule_no"), F.lit(n).alias("rule"), F.col(f"vote_{n}").alias("vote")) for i, n in enumerate(names)]
    )
    return votes.select(*keep, F.explode(cells).alias("v")).select(*keep, "v.*")


def rule_statistics(votes: DataFrame, names: Sequence[str], *, label: str | None = "label") -> DataFrame:
    """Coverage, accuracy on rows that voted (0.5 if none), and vote counts.

    All rules are counted in a single pass, without exploding the rows.
    """
    aggs = [F.count("*").alias("_n")]
    for n in names:
        v = F.col(f"vote_{n}")
        aggs += [F.count_if(v == 1).alias(f"_p_{n}"), F.count_if(v == 0).alias(f"_q_{n}")]
        if label:
            aggs.append(F.count_if((v != lx.ABSTAIN) & (v == F.col(label))).alias(f"_ok_{n}"))
    wide = votes.agg(*aggs)
    rows = []
    for i, n in enumerate(names):
        cast = F.col(f"_p_{n}") + F.col(f"_q_{n}")
        acc = (
            F.when(cast == 0, F.lit(0.5)).otherwise(F.col(f"_ok_{n}") / F.greatest(cast, F.lit(1)))
            if label else F.lit(None).cast("double")
        )
        rows.append(
            F.struct(
                F.lit(i).alias("rule_no"), F.lit(n).alias("rule"), (cast / F.col("_n")).alias("coverage"),
                acc.alias("accuracy"), F.col(f"_p_{n}").alias("n_pos"), F.col(f"_q_{n}").alias("n_neg"),
            )
        )
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def weights_by_accuracy(stats: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row, one weight column per rule: the input of ``vote``."""
    return stats.agg(*[F.max(F.when(F.col("rule") == n, F.col("accuracy"))).alias(f"w_{n}") for n in names])


def vote(votes: DataFrame, names: Sequence[str], weights: DataFrame | None = None) -> DataFrame:
    """Adds weak_label, confidence and all_abstain.

    ``weights`` is a one-row table (see ``weights_by_accuracy``); without it
    every rule weighs 1.
    """
    ws = None
    if weights is not None:
        packed = weights.select(F.struct(*[f"w_{n}" for n in names]).alias("w"))
        votes = votes.withColumn("_w", packed.scalar())
        ws = [F.coalesce(F.col(f"_w.w_{n}"), F.lit(0.5)) for n in names]
    label, conf, silent = weighted_vote(vote_columns(names), ws)
    return votes.withColumns({"weak_label": label, "confidence": conf, "all_abstain": silent}).drop("_w")


def label_distribution(df: DataFrame, *, label: str = "weak_label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def rule_overlap(votes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Overlap and conflict share for each pair of rules, one pass, no self-join."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    aggs = [F.count("*").alias("_n")]
    for a, b in pairs:
        va, vb = F.col(f"vote_{a}"), F.col(f"vote_{b}")
        both = (va != lx.ABSTAIN) & (vb != lx.ABSTAIN)
        aggs += [F.count_if(both).alias(f"_o_{a}_{b}"), F.count_if(both & (va != vb)).alias(f"_c_{a}_{b}")]
    wide = votes.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("rule_a"), F.lit(b).alias("rule_b"), (F.col(f"_o_{a}_{b}") / F.col("_n")).alias("overlap"),
                (F.col(f"_c_{a}_{b}") / F.col("_n")).alias("conflict"),
            )
            for a, b in pairs
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def combine_rule_and_score(df: DataFrame, rule_label: Column, *, score: str = "model_score", threshold: float = 0.8) -> DataFrame:
    """Adds weak_label and label_source."""
    label, source = rule_then_score(rule_label, F.col(score), threshold)
    return df.withColumns({"weak_label": label, "label_source": source})


def compare_sources(metrics: DataFrame, baseline: str, *, source: str = "source", value: str = "macro_f1") -> DataFrame:
    """Adds the gain of every label source over the baseline source, in points."""
    base = metrics.where(F.col(source) == baseline).agg(F.max(value).alias("b"))
    return metrics.withColumn("gain", (F.col(value) - base.scalar()) * 100)


def route(df: DataFrame, *, score: str = "score", margin: float = 0.3) -> DataFrame:
    """Adds ``route``: keep the cheap model's label when it is sure, else review."""
    return df.withColumn("route", F.when(F.abs(F.col(score) - 0.5) >= margin, "auto").otherwise("review"))
