"""Text augmentation as Column expressions.

Every choice is drawn from ``key``, a hex md5 that names the row, the copy and
the seed, so the same variant comes out on any cluster. A text is cut into
segments that concatenate back to it: a Han character (or dictionary word), or
a run of other characters with the white space behind it.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from . import lexicons as lx
from .hashing import chance, draw


def segments(text: Column, dictionary: Sequence[str] = ()) -> Column:
    known = "".join(re.escape(w) + "|" for w in sorted(dictionary, key=len, reverse=True) if re.search(r"[一-鿿]", w))
    return F.regexp_extract_all(text, F.lit(rf"({known}\p{{IsHan}}|[^\p{{IsHan}}\s]+\s*|\s+)"), F.lit(1))


def sub_key(key: Column, *parts: Column | str | int) -> Column:
    """A new draw that belongs to one step or position."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", key, *[c.cast("string") for c in cols]))


def _join(segs: Column) -> Column:
    return F.array_join(segs, "")


def random_deletion(segs: Column, key: Column, p: float = 0.1) -> Column:
    """Drop each segment with probability p; one segment always stays."""
    kept = F.filter(segs, lambda s, i: ~chance(sub_key(key, "rd", i), p))
    one = F.element_at(segs, (draw(sub_key(key, "rd-keep"), F.size(segs)) + 1).cast("int"))
    return F.when(F.size(segs) <= 1, _join(segs)).when(F.size(kept) == 0, one).otherwise(_join(kept))


def random_swap(segs: Column, key: Column, n: int = 1) -> Column:
    """Exchange n pairs of different positions; shorter texts stay as they are."""
    size = F.size(segs)
    at = lambda arr, i: F.element_at(arr, (i + 1).cast("int"))

    def exchange(arr: Column, pair: Column) -> Column:
        # The pair is bound once; inside the inner lambda it is a variable.
        swapped = F.transform(
            F.array(pair),
            lambda p: F.transform(arr, lambda s, i: F.when(i == p["a"], at(arr, p["b"])).when(i == p["b"], at(arr, p["a"])).otherwise(s)),
        )
        return F.element_at(swapped, 1)

    out = segs
    for step in range(n):
        a = draw(sub_key(key, "rs-a", step), F.greatest(size, F.lit(1)))
        b = draw(sub_key(key, "rs-b", step), F.greatest(size - 1, F.lit(1)))
        out = exchange(out, F.struct(a.alias("a"), F.when(b >= a, b + 1).otherwise(b).alias("b")))
    return F.when(size < 2, _join(segs)).otherwise(_join(out))


def _pick(options: Column, key: Column) -> Column:
    return F.element_at(options, (draw(key, F.size(options)) + 1).cast("int"))


def synonym_replace(segs: Column, key: Column, synonyms: Mapping[str, Sequence[str]] = lx.SYNONYMS, p: float = 0.1) -> Column:
    """Replace each known word with probability p by one of its synonyms."""

    def one(s: Column, i: Column) -> Column:
        word = F.rtrim(s)
        out = F.when(F.lit(False), s)
        for w, options in synonyms.items():
            swap = _pick(F.array(*[F.lit(o) for o in options]), sub_key(key, "syn-pick", i))
            out = out.when((word == w) & chance(sub_key(key, "syn", i), p), F.concat(swap, F.substring(s, F.lit(len(w) + 1), F.length(s))))
        return out.otherwise(s)

    return _join(F.transform(segs, one))


def char_replace(text: Column, key: Column, table: Mapping[str, Sequence[str]], p: float) -> Column:
    """Per character: replace a listed one with probability p."""

    def one(ch: Column, i: Column) -> Column:
        out = F.when(F.lit(False), ch)
        for w, options in table.items():
            out = out.when((ch == w) & chance(sub_key(key, "ch", i), p), _pick(F.array(*[F.lit(o) for o in options]), sub_key(key, "ch-pick", i)))
        return out.otherwise(ch)

    return F.when(
        functools.reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in table]), _join(F.transform(F.split(text, ""), one))
    ).otherwise(text)


def add_typo(text: Column, key: Column, pairs: Sequence[tuple[str, str]] = lx.TYPO_PAIRS, p: float = 0.1) -> Column:
    """The first listed pair that occurs and is drawn replaces one occurrence."""
    out = F.when(F.lit(False), text)
    for j, (src, dst) in enumerate(pairs):
        hit = F.contains(text, F.lit(src)) & chance(sub_key(key, "typo", j), p)
        out = out.when(hit, F.overlay(text, F.lit(dst), F.instr(text, src), F.lit(len(src))))
    return out.otherwise(text)


def add_emoji(text: Column, key: Column, table: Sequence[tuple[str, str]] = lx.EMOJI_BY_WORD, p: float = 0.3) -> Column:
    """Append the emoji of the first keyword that occurs and is drawn."""
    out = F.when(F.lit(False), text)
    for j, (word, emoji) in enumerate(table):
        out = out.when(F.contains(text, F.lit(word)) & chance(sub_key(key, "emoji", j), p), F.concat(text, F.lit(emoji)))
    return out.otherwise(text)


def _whole_lines(pattern: str) -> str:
    """The same pattern, tried at line starts only, if it takes whole lines.

    What begins and ends with ``(.*)`` matches from the start of a line to its
    end or nowhere in it. Unanchored, a line without a match is scanned again
    from each of its characters, which is quadratic in its length.
    """
    whole = re.fullmatch(r"\(\.\*\)([^\\?|]|\((?:[^\\?()]|\|)*\))*\(\.\*\)", pattern)
    return "(?m)^" + pattern if whole else pattern


def rewrite(text: Column, key: Column, rules: Sequence[tuple[str, str]] = lx.REWRITES, p: float = 0.3) -> Column:
    """Each regular-expression rewrite is applied with probability p."""
    out = text
    for j, (pattern, repl) in enumerate(rules):
        out = F.when(chance(sub_key(key, "bt", j), p), F.regexp_replace(out, _whole_lines(pattern), repl)).otherwise(out)
    return out


OPERATIONS = ("rd", "rs", "synonym", "typo", "emoji", "backtrans")


def augment(
    text: Column, segs: Column, key: Column, methods: Sequence[str] = ("rd", "rs", "synonym"), *, synonyms=lx.SYNONYMS,
    typos=lx.TYPO_PAIRS, emojis=lx.EMOJI_BY_WORD, rewrites=lx.REWRITES,
) -> Column:
    """One operation per copy, chosen by the key."""
    unknown = set(methods) - set(OPERATIONS)
    if unknown:
        raise ValueError(f"unknown operations: {sorted(unknown)}")
    make = {
        "rd": lambda: random_deletion(segs, key, 0.1),
        "rs": lambda: random_swap(segs, key, 1),
        "synonym": lambda: synonym_replace(segs, key, synonyms, 0.15),
        "typo": lambda: add_typo(text, key, typos, 0.1),
        "emoji": lambda: add_emoji(text, key, emojis, 0.3),
        "backtrans": lambda: rewrite(text, key, rewrites, 0.3),
    }
    pick = draw(sub_key(key, "op"), len(methods))
    out = F.when(F.lit(False), text)
    for i, m in enumerate(methods):
        out = out.when(pick == i, make[m]())
    return out.otherwise(text)
