"""Labelling rules as Column expressions: text in, 1 / 0 / -1 out.

A rule is any callable ``Column -> Column``; a rule set is an ordered dict of
name to rule. Rules stay inside code generation, so a table of any size is
labelled in one pass without a shuffle.
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F

from . import lexicons as lx
from .hashing import hash_int, hash_key
from .text import contains_any, count_char, presence_count

Rule = Callable[[Column], Column]


def _label(v: int) -> Column:
    return F.lit(v).cast("int")


def keyword_rule(pos: Sequence[str], neg: Sequence[str], threshold: int = 1) -> Rule:
    """The side with strictly more keywords wins if it reaches the threshold."""

    def rule(text: Column) -> Column:
        p, n = presence_count(text, pos), presence_count(text, neg)
        return (
            F.when((p >= threshold) & (p > n), _label(lx.POSITIVE))
            .when((n >= threshold) & (n > p), _label(lx.NEGATIVE))
            .otherwise(_label(lx.ABSTAIN))
        )

    return rule


def negation_rule(negators: Sequence[str] = lx.NEGATORS, pos: Sequence[str] = lx.NEGATED_POS) -> Rule:
    """A negator directly, or one space, before a positive word means negative."""
    alt = lambda ws: "|".join(re.escape(w) for w in ws)
    pattern = f"({alt(negators)}) ?({alt(pos)})"
    return lambda text: F.when(text.rlike(pattern), _label(lx.NEGATIVE)).otherwise(_label(lx.ABSTAIN))


def first_match_rule(pos: Sequence[str], neg: Sequence[str], pos_first: bool = True) -> Rule:
    """Any word of the first side decides; then the second; else abstain."""

    def rule(text: Column) -> Column:
        sides = [(pos, lx.POSITIVE), (neg, lx.NEGATIVE)]
        (w1, v1), (w2, v2) = sides if pos_first else sides[::-1]
        return (
            F.when(contains_any(text, w1), _label(v1))
            .when(contains_any(text, w2), _label(v2))
            .otherwise(_label(lx.ABSTAIN))
        )

    return rule


def short_text_rule(pos=lx.SHORT_POS, neg=lx.SHORT_NEG, max_len: int = 10) -> Rule:
    inner = first_match_rule(pos, neg)
    return lambda text: F.when(F.length(text) <= max_len, inner(text)).otherwise(_label(lx.ABSTAIN))


def exclamation_rule(neg=lx.EXCLAMATION_NEG, min_marks: int = 2) -> Rule:
    return lambda text: (
        F.when(count_char(text, "!") < min_marks, _label(lx.ABSTAIN))
        .when(contains_any(text, neg), _label(lx.NEGATIVE))
        .otherwise(_label(lx.POSITIVE))
    )


def default_rules() -> dict[str, Rule]:
    return {
        "basic_keywords": keyword_rule(lx.GENERAL_POS, lx.GENERAL_NEG, 2),
        "service_keywords": keyword_rule(lx.SERVICE_POS, lx.SERVICE_NEG, 1),
        "environment_keywords": keyword_rule(lx.ENVIRONMENT_POS, lx.ENVIRONMENT_NEG, 1),
        "negation": negation_rule(),
        "length": short_text_rule(),
        "exclamation": exclamation_rule(),
        "comparison": first_match_rule(lx.COMPARISON_POS, lx.COMPARISON_NEG),
        "emoji": first_match_rule(lx.EMOJI_POS, lx.EMOJI_NEG),
        "recommend": first_match_rule(lx.RECOMMEND_POS, lx.RECOMMEND_NEG),
    }


def votes(text: Column, rules: Mapping[str, Rule]) -> Column:
    """All rules at once: one array column in rule order."""
    return F.array(*[r(text) for r in rules.values()])


def _weight_sums(vote_cols: Sequence[Column], weights: Sequence[Column]) -> tuple[Column, Column]:
    def side(v: int) -> Column:
        return functools.reduce(
            operator.add, [F.when(c == v, w).otherwise(F.lit(0.0)) for c, w in zip(vote_cols, weights)]
        )

    return side(lx.POSITIVE), side(lx.NEGATIVE)


def weighted_vote(vote_cols: Sequence[Column], weights: Sequence[Column | float] | None = None) -> tuple[Column, Column, Column]:
    """(label, confidence, all_abstain). A tie goes to negative with its share;
    when nobody votes the label is 0 with confidence 0.5."""
    ws = [w if isinstance(w, Column) else F.lit(float(w)) for w in (weights or [1.0] * len(vote_cols))]
    pos, neg = _weight_sums(vote_cols, ws)
    total = pos + neg
    silent = total == 0
    label = F.when(pos > neg, _label(lx.POSITIVE)).otherwise(_label(lx.NEGATIVE))
    conf = F.when(silent, F.lit(0.5)).otherwise(F.greatest(pos, neg) / F.when(silent, F.lit(1.0)).otherwise(total))
    return label, conf, silent


def keyword_label(text: Column, pos=lx.GENERAL_POS, neg=lx.GENERAL_NEG, *, tie_id: Column | None = None, seed: int = 42) -> Column:
    """1 when more positive than negative keywords occur, else 0.

    With ``tie_id`` a tie is decided by hash parity instead of going to 0.
    """
    p, n = presence_count(text, pos), presence_count(text, neg)
    out = F.when(p > n, _label(1))
    if tie_id is not None:
        out = out.when(p == n, F.pmod(hash_int(hash_key(tie_id, seed)), F.lit(2)).cast("int"))
    return out.otherwise(_label(0))


def lexicon_score(text: Column, pos: Sequence[str], neg: Sequence[str]) -> Column:
    """Sentiment score in (0,1): smoothed share of positive keywords.

    Blank or missing text scores the neutral 0.5.
    """
    p, n = presence_count(text, pos), presence_count(text, neg)
    blank = text.isNull() | (F.trim(text) == "")
    return F.when(blank, F.lit(0.5)).otherwise((p + 1) / (p + n + 2))


def threshold_label(score: Column, threshold: float = 0.5, inclusive: bool = True) -> Column:
    s = F.coalesce(score, F.lit(0.5))
    return (s >= threshold if inclusive else s > threshold).cast("int")


def rule_then_score(rule_label: Column, score: Column, threshold: float = 0.8) -> tuple[Column, Column]:
    """(label, source): the rule if it spoke, else a confident score, else abstain."""
    by_rule = rule_label != lx.ABSTAIN
    high, low = score >= threshold, score <= F.lit(1.0) - F.lit(threshold)
    label = (
        F.when(by_rule, rule_label).when(high, _label(1)).when(low, _label(0)).otherwise(_label(lx.ABSTAIN))
    )
    source = (
        F.when(by_rule, F.lit("rule")).when(high, F.lit("model_high")).when(low, F.lit("model_low"))
        .otherwise(F.lit("abstain"))
    )
    return label, source


def policy_label(text: Column, policy: Mapping[str, int] = lx.POLICY_RULES) -> Column:
    """First policy word that occurs gives its label, else abstain."""
    out = None
    for word, lab in policy.items():
        hit = F.contains(text, F.lit(word))
        out = F.when(hit, _label(lab)) if out is None else out.when(hit, _label(lab))
    return out.otherwise(_label(lx.ABSTAIN))
