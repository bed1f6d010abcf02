"""Column expressions over review text. No UDF except where noted."""

from __future__ import annotations

import functools
import operator
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from . import lexicons as lx

NON_WORD = r"[^\p{L}\p{N}_]+"
ESCAPE = r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\x[0-9a-fA-F]{2}"
CONTROL = r"[\x00-\x1f\x7f-\x9f]"


def simple_clean(text: Column) -> Column:
    """NULL to '', line breaks to spaces, outer white space trimmed."""
    flat = F.translate(F.coalesce(text, F.lit("")), "\r\n", "  ")
    return F.regexp_replace(flat, r"(?U)^\s+|\s+$", "")


def _escaped_character(match: Column) -> Column:
    digits = F.regexp_replace(match, r"\\[ux]", "")
    units = F.lower(F.when(F.length(digits) == 2, F.concat(F.lit("00"), digits)).otherwise(digits))
    kept = (F.length(units) == 4) & ((units <= "007f") | units.between("d800", "dfff"))
    return F.when(kept, match).otherwise(F.decode(F.unhex(units), "UTF-16BE"))


def decode_escapes(text: Column) -> Column:
    r"""Turn literal ``\uXXXX`` / ``\xHH`` into characters, one match at a time.

    A match is taken only when the result is non-ASCII, so real text around it
    stays as it is. Two escapes that form a surrogate pair are one character; a
    lone surrogate stays as written.
    """
    found = F.transform(F.regexp_extract_all(text, F.lit(ESCAPE), F.lit(0)), _escaped_character)
    pieces = F.zip_with(F.split(text, ESCAPE, -1), found, lambda plain, ch: F.concat(plain, F.coalesce(ch, F.lit(""))))
    return F.when(text.rlike(ESCAPE), F.array_join(pieces, "")).otherwise(text)


def strip_control(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, "")


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode NFKC form (Spark has no normalisation function)."""
    return s.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


def fold_fullwidth(text: Column) -> Column:
    """Full-width ASCII and the ideographic space, the common part of NFKC."""
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
    plain = "".join(chr(c) for c in range(0x21, 0x7F)) + " "
    return F.translate(text, wide, plain)


def char_length(text: Column) -> Column:
    return F.length(text)


def word_count(text: Column) -> Column:
    """Number of white-space separated words."""
    return F.regexp_count(text, F.lit(r"\S+"))


def truncate_display(text: Column, n: int = 10) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def _han_bigrams(run: Column) -> Column:
    return F.when(
        run.rlike(r"^\p{IsHan}{2,}$"),
        F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substring(run, i, F.lit(2))),
    ).otherwise(F.array(run))


def words(text: Column, lower: bool = True) -> Column:
    """Split on non-word characters; runs of Han become character bigrams."""
    t = F.lower(text) if lower else text
    spaced = F.split(t, NON_WORD)
    han = F.flatten(F.transform(F.split(F.regexp_replace(t, r"(\p{IsHan}+)", " $1 "), NON_WORD), _han_bigrams))
    # All Han lie in this range; looking up the script of every character of a text without any costs more than the split.
    return F.when(t.rlike(r"[\u2E80-\x{3FFFF}]") & t.rlike(r"\p{IsHan}"), han).otherwise(spaced)


def tokenize(text: Column, stopwords: Sequence[str] = lx.STOPWORDS_14, min_len: int = 1, lower: bool = True) -> Column:
    """Tokens without blanks, stop words, or tokens shorter than ``min_len``."""
    stops = list(stopwords)

    def keep(w: Column) -> Column:
        ok = F.length(w) >= min_len
        return ok & ~w.isin(stops) if stops else ok

    return F.filter(words(text, lower), keep)


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def split_joined(tokens_join: Column) -> Column:
    return F.filter(F.split(tokens_join, " "), lambda w: w != "")


def ngrams_1_2(tokens: Column) -> Column:
    """Unigrams followed by space-joined bigrams."""
    n = F.size(tokens)
    bigrams = F.zip_with(
        F.slice(tokens, 1, F.greatest(n - 1, F.lit(0))),
        F.slice(tokens, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.concat(tokens, bigrams)


def presence_count(text: Column, keywords: Sequence[str], lower: bool = True) -> Column:
    """How many of the keywords occur (each counted at most once)."""
    t = F.lower(text) if lower else text
    return functools.reduce(operator.add, [F.contains(t, F.lit(k)).cast("int") for k in keywords])


def contains_any(text: Column, keywords: Sequence[str]) -> Column:
    return functools.reduce(operator.or_, [F.contains(text, F.lit(k)) for k in keywords])


def emoji_to_word(text: Column, classes=lx.EMOJI_CLASSES) -> Column:
    return functools.reduce(lambda t, c: F.regexp_replace(t, c[0], c[1]), classes, text)


def count_char(text: Column, ch: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))


def label_word(label: Column, words_=lx.LABEL_WORDS) -> Column:
    return F.when(label == 1, F.lit(words_[1])).otherwise(F.lit(words_[0]))
