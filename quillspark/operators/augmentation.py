"""Augmented tables and the low-resource experiment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import augment as A, lexicons as lx
from ..functions.hashing import hash_key
from ..functions.text import emoji_to_word
from . import bayes as NB
from .metrics import summary


def variants(
    df: DataFrame, multiplier: int = 3, methods: Sequence[str] = ("rd", "rs", "synonym"), *, id_col: str = "doc_id",
    text: str = "text", seed: int = 42, synonyms=lx.SYNONYMS, **tables,
) -> DataFrame:
    """``multiplier`` variants of each row in ``aug_text``, numbered by ``copy``.

    The segment array is a column of its own, so a text is cut once per row.
    """
    base = df.withColumn("_segs", A.segments(F.col(text), list(synonyms)))
    base = base.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(multiplier))))
    base = base.withColumn("_key", A.sub_key(hash_key(id_col, seed), F.col("copy")))
    aug = A.augment(F.col(text), F.col("_segs"), F.col("_key"), methods, synonyms=synonyms, **tables)
    return base.withColumn("aug_text", aug).drop("_segs", "_key")


def accepted(text: str = "text", aug: str = "aug_text", tolerance: float = 0.2) -> Column:
    """Changed, and within the length tolerance."""
    n, m = F.length(text), F.length(aug)
    return (F.col(aug) != F.col(text)) & (m >= F.lit(1 - tolerance) * n) & (m <= F.lit(1 + tolerance) * n)


def augment_table(
    df: DataFrame, multiplier: int = 3, methods: Sequence[str] = ("rd", "rs", "synonym"), *, keep: Sequence[str] = ("doc_id", "label"),
    text: str = "text", **kw,
) -> DataFrame:
    """Each original twice plus its accepted variants: keep columns, text, origin."""
    twice = df.select(*keep, text, F.explode(F.array(F.lit("original-1"), F.lit("original-2"))).alias("origin"))
    new = variants(df, multiplier, methods, text=text, **kw).where(accepted(text))
    return twice.unionByName(new.select(*keep, F.col("aug_text").alias(text), F.concat(F.lit("variant-"), "copy").alias("origin")))


def chain(
    df: DataFrame, *, id_col: str = "doc_id", text: str = "text", seed: int = 42, synonyms: Mapping[str, Sequence[str]] = lx.CHAR_SYNONYMS,
    typos: Mapping[str, Sequence[str]] = lx.CHAR_TYPOS, emoji=lx.EMOJI_CLASSES, synonym_ratio: float = 0.1, typo_ratio: float = 0.05,
) -> DataFrame:
    """Adds ``aug_text``: synonym, then emoji word, then typo, per character."""
    key = hash_key(id_col, seed)
    df = df.withColumn("_1", A.char_replace(F.col(text), A.sub_key(key, "synonym"), synonyms, synonym_ratio))
    df = df.withColumn("_2", emoji_to_word(F.col("_1"), emoji))
    return df.withColumn("aug_text", A.char_replace(F.col("_2"), A.sub_key(key, "typo"), typos, typo_ratio)).drop("_1", "_2")


def low_resource(
    train: DataFrame, test: DataFrame, *, multiplier: int = 3, methods: Sequence[str] = ("rd", "rs", "synonym"), max_features: int = 3000, **kw
) -> DataFrame:
    """(setting, n_train, macro_f1) of Naive Bayes on the plain and on the
    augmented training rows. Test rows that are training rows are left out."""
    clean_test = test.join(train.select("doc_id"), "doc_id", "left_anti")
    plain = train.select("doc_id", "label", "text")
    grown = augment_table(plain, multiplier, methods, **kw)
    both = plain.select("label", "text", F.lit(1).alias("w_base"), F.lit(0).alias("w_aug")).unionByName(
        grown.select("label", "text", F.lit(0).alias("w_base"), F.lit(1).alias("w_aug"))
    )
    w = {"base": F.col("w_base"), "aug": F.col("w_aug")}
    model = NB.fit(both, w, max_features=max_features)
    prior = NB.priors(both, w)
    scored = NB.score(clean_test, model, prior, ["base", "aug"], keep=["label"])
    long = NB.predict_long(scored, ["base", "aug"], ["label"], name="setting")
    sizes = both.agg(F.sum("w_base").alias("base"), F.sum("w_aug").alias("aug")).select(
        F.explode(F.array(F.struct(F.lit("base").alias("setting"), F.col("base").alias("n_train")), F.struct(F.lit("aug").alias("setting"), F.col("aug").alias("n_train")))).alias("e")
    ).select("e.*")
    return summary(long, ["setting"]).select("setting", "macro_f1").join(sizes, "setting")
