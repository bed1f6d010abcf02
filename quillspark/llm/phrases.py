"""Phrase collocations by Toivonen's sampling: propose on a sample, count exactly on all rows.

All phrases of a sample that are frequent there (at a lowered count) are
proposed. The full pass counts every phrase whose two parts (without the last
and without the first word) are proposed: these are the proposals and their
negative border, that is the smallest phrases that were not proposed, single
words included. If a phrase of the border turns out frequent, the border fails:
it joins the proposals, and an expansion pass counts the phrases that this adds,
those that grow out of phrases it counts itself included. So one expansion
closes the set: all frequent phrases are counted, whatever the sample.

The proposals travel as one bit array for each length (a Bloom filter of at
most ``MOST_BITS``), so what is broadcast is bounded. A false hit has a phrase
counted without need; the counts stay exact. Each phrase is counted by exactly
one pass.

Nulls: a null text has no words, a null lang is ``und``. Equal rows count each.
Texts of any length are cut up whole; a task holds the codes of a
million words at a time. Empty tables give no phrase. More columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import stage
from .common import ascii_lowered, spread_rows

BREAKS = ".,;:!?\n\x0b\x0c\r"
_TOKEN = re.compile(r"[.,;:!?\x0A-\x0D]|[^\x20\x09.,;:!?\x0A-\x0D]+")
#: Words whose codes a task holds before it hands on their counts.
HELD = 1_000_000
#: Bits of a filter: 32 a proposal, between these bounds (16 MB).
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_COUNTS = "lang string, size int, phrase string, f long"


class _Codes(dict):
    """Numbers of words from 1; all signs that end a piece are 0."""

    def __init__(self):
        super().__init__((c, 0) for c in BREAKS)

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self) - len(BREAKS) + 1
        return n

    def words(self) -> list[str]:
        return list(self)[len(BREAKS) :]


def _word_hash(lang: str, words: Iterable[str]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), seed) for w in words], np.uint64)


def _extend(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase with one more word."""
    x = phrase * _A + (word ^ (word >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def _probes(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three places of a hash in an array of ``bits`` (a power of two)."""
    mask = np.uint64(bits - 1)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [(h + np.uint64(i) * step) & mask for i in range(3)]


def _holds(array: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    """Which hashes are in a filter; None holds everything."""
    if array is None:
        return np.ones(len(h), bool)
    out = np.ones(len(h), bool)
    for at in _probes(h, len(array) * 64):
        out &= (array[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def _distinct(columns: list[np.ndarray], top: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns of numbers up to ``top``, and how often each occurs."""
    bits = max(int(top).bit_length(), 1)
    if bits * len(columns) <= 63:
        key = columns[0].astype(np.int64)
        for c in columns[1:]:
            key = (key << bits) | c
        key, n = np.unique(key, return_counts=True)
        return [(key >> (bits * (len(columns) - 1 - i))) & ((1 << bits) - 1) for i in range(len(columns))], n
    order = np.lexsort(columns[::-1])
    rows = np.stack([c[order] for c in columns])
    first = np.flatnonzero(np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0))[: rows.shape[1]])
    return list(rows[:, first]), np.diff(np.append(first, rows.shape[1]))


Filters = list  # one bit array (or None: all) for each length of phrase below the longest


def _counted(lang: str, codes: np.ndarray, words: list[str], max_words: int, first: Filters | None, now: Filters) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(length, phrases, counts) of a stretch.

    The full pass (``first`` is None) counts all words and the phrases whose
    parts ``now`` holds. The expansion counts the phrases that the full pass,
    with its filters ``first``, did not, if their parts are held by ``now`` or
    counted by the expansion itself.
    """
    lookup = pa.array(words, pa.string())
    if first is None:
        n = np.bincount(codes, minlength=len(words) + 1)
        yield 0, pa.array([""]), np.array([n[1:].sum()])
        some = np.flatnonzero(n[1:])
        yield 1, lookup.take(pa.array(some)), n[1:][some]
    zero = np.zeros(1, np.uint64)
    hashed = any(f is not None for f in now)
    word_hash = np.concatenate([zero, _word_hash(lang, words)]) if hashed else np.zeros(len(words) + 1, np.uint64)
    break_is_out = np.arange(len(words) + 1) > 0
    inside = (_holds(now[0], word_hash) & break_is_out)[codes]
    before = (_holds(first[0], word_hash) & break_is_out)[codes] if first is not None else None
    ends = word_hash[codes]
    for size in range(2, max_words + 1):
        m = len(codes) - size + 1
        if m <= 0:
            return
        both = inside[:m] & inside[1 : m + 1]
        take = both if before is None else both & ~(before[:m] & before[1 : m + 1])
        at = np.flatnonzero(take)
        if len(at):
            columns, n = _distinct([codes[at + i] for i in range(size)], len(words))
            yield size, pc.binary_join_element_wise(*[lookup.take(pa.array(c - 1)) for c in columns], " "), n
        if size == max_words:
            return
        # a phrase that is held has held parts, so only those places are looked up
        at = np.flatnonzero(both)
        h = ends[at]
        for i in range(1, size):
            h = _extend(h, ends[at + i])
        inside, held = np.zeros(m, bool), _holds(now[size - 1], h)
        inside[at] = held if first is None else held | take[at]
        if first is not None:
            before, was = np.zeros(m, bool), before[:m] & before[1 : m + 1]
            old = was[at]
            before[at[old]] = _holds(first[size - 1], h[old])


def count_phrases(rows: DataFrame, max_words: int, first: Filters | None, now: Filters, held: int = HELD) -> DataFrame:
    """(lang, size, phrase, f): exact counts of one pass; size 0 holds the number of words.

    A task counts stretches of ``held`` words on its own before anything is
    shuffled. Longer texts are cut where a phrase is counted on one side only.
    """
    shared = rows.sparkSession.sparkContext.broadcast((first, now))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, after = shared.value
        codes: dict[str, _Codes] = {}
        parts: dict[str, list[np.ndarray]] = {}
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in list(parts):
                # a break lies between texts, so no phrase runs across
                yield from _rows(lang, np.concatenate(parts.pop(lang)), codes.pop(lang).words(), max_words, before, after)

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, found = lang.as_py(), _TOKEN.findall(ascii_lowered(text.as_py()))
                if len(found) > held:
                    yield from _long_text(lang, found, max_words, before, after, held)
                    continue
                number = codes.setdefault(lang, _Codes()).__getitem__
                got = np.fromiter(map(number, found), np.int32, len(found))
                parts.setdefault(lang, []).extend((got, np.zeros(1, np.int32)))
                total += len(found)
                if total >= held:
                    yield from flush()
                    total = 0
        yield from flush()

    # a task's counts hardly meet again in it, so they are added up behind the shuffle
    partial = rows.mapInArrow(run, _COUNTS).repartition("lang", "size", "phrase")
    return partial.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))


def _rows(lang: str, codes: np.ndarray, words: list[str], max_words: int, before: Filters | None, after: Filters, sign: int = 1) -> Iterator[pa.RecordBatch]:
    for size, phrase, n in _counted(lang, codes, words, max_words, before, after):
        k = len(n)
        columns = [pa.array([lang] * k, pa.string()), pa.array(np.full(k, size, np.int32)), phrase, pa.array(sign * n.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "f"])


def _long_text(lang: str, found: list[str], max_words: int, before: Filters | None, after: Filters, held: int) -> Iterator[pa.RecordBatch]:
    """Counts of one text in stretches that overlap by ``max_words`` - 1 tokens; what the overlap holds is taken off again."""
    for at in range(0, len(found), held):
        for shift, sign in ((0, 1), (held, -1)):
            some = found[at + shift : at + held + max_words - 1]
            if not some:
                continue
            codes = _Codes()
            got = np.fromiter(map(codes.__getitem__, some), np.int32, len(some))
            yield from _rows(lang, got, codes.words(), max_words, before, after, sign)


class _WordHashes(dict):
    """Hashes of the words of one language, each computed once."""

    def __init__(self, lang: str):
        super().__init__()
        self.lang = lang

    def __missing__(self, word: str) -> np.uint64:
        self[word] = h = _word_hash(self.lang, [word])[0]
        return h


def _hashes(lang: pa.Array, size: np.ndarray, phrase: pa.Array) -> np.ndarray:
    """Hashes of phrases as the counting pass computes them."""
    out = np.zeros(len(size), np.uint64)
    for g in pc.unique(lang).to_pylist():
        known = _WordHashes(g)
        mine = pc.equal(lang, g).to_numpy(zero_copy_only=False)
        for s in np.unique(size[mine]):
            at = np.flatnonzero(mine & (size == s))
            words = " ".join(phrase.take(pa.array(at)).to_pylist()).split(" ")
            columns = np.fromiter(map(known.__getitem__, words), np.uint64, len(words)).reshape(-1, s)
            h = columns[:, 0]
            for w in range(1, s):
                h = _extend(h, columns[:, w])
            out[at] = h
    return out


def build_filters(phrases: DataFrame, max_words: int, most_bits: int = MOST_BITS, beside: Filters | None = None) -> Filters:
    """One bit array for each length 1 .. max_words - 1, put together from parts of all tasks.

    With ``beside``, the phrases are added to those filters, and the arrays are
    at least as long.
    """
    sizes = {r["size"]: r["n"] for r in phrases.groupBy("size").agg(F.count("*").alias("n")).collect()}
    bits = [min(max(1 << (32 * sizes.get(s, 0)).bit_length(), LEAST_BITS), most_bits) for s in range(1, max_words)]
    if beside is not None:
        bits = [max(b, 64 * len(f)) for b, f in zip(bits, beside)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("size").to_numpy()
            h = _hashes(batch.column("lang"), size, batch.column("phrase"))
            for s in np.unique(size):
                at = np.concatenate(_probes(h[size == s], bits[s - 1]))
                slot, back = np.unique(at >> np.uint64(6), return_inverse=True)
                value = np.zeros(len(slot), np.uint64)
                np.bitwise_or.at(value, back, np.uint64(1) << (at & np.uint64(63)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slot), s, np.int32)), pa.array(slot.astype(np.int64)), pa.array(value.view(np.int64))], ["size", "slot", "bits"]
                )

    merged = phrases.select("lang", "size", "phrase").mapInArrow(run, "size int, slot long, bits long").groupBy("size", "slot").agg(F.bit_or("bits").alias("bits"))
    # places are remainders of powers of two, so a longer array holds a shorter one several times
    out = [np.zeros(b // 64, np.uint64) if beside is None else np.tile(beside[i], b // 64 // len(beside[i])) for i, b in enumerate(bits)]
    got = merged.toArrow()  # at most most_bits / 64 rows for each length
    size, slot, value = (got.column(c).to_numpy() for c in ("size", "slot", "bits"))
    for s in range(1, max_words):
        out[s - 1][slot[size == s]] |= value[size == s].view(np.uint64)
    return out


def outside(phrases: DataFrame, filters: Filters) -> DataFrame:
    """The phrases that no filter holds."""
    shared = phrases.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = shared.value
        for batch in batches:
            size = batch.column("size").to_numpy()
            h = _hashes(batch.column("lang"), size, batch.column("phrase"))
            inside = np.zeros(len(size), bool)
            for s in np.unique(size):
                inside[size == s] = _holds(arrays[s - 1], h[size == s])
            yield batch.filter(pa.array(~inside))

    return phrases.select("lang", "size", "phrase", "f").mapInArrow(run, _COUNTS)


def frequent_phrases(
    docs: DataFrame, *, min_count: int = 10, max_words: int = 3, one_in: int = 4, lang: str = "lang", text: str = "text",
    most_bits: int = MOST_BITS, held: int = HELD,
) -> DataFrame:
    """(lang, size, phrase, f): all phrases that occur ``min_count`` times, and the words of each lang as size 0.

    ``one_in``: the sample is one in so many rows, so it grows with the input;
    its counts are held against half of what a phrase at the limit would have.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample, rows = spread_rows(rows.sample(1 / one_in, 7)), spread_rows(rows)
    lowered = max(2, min_count // (2 * one_in))
    everything: Filters = [None] * (max_words - 1)
    proposed = count_phrases(sample, max_words, None, everything, held).where((F.col("f") >= lowered) & F.col("size").between(1, max_words - 1))
    first = build_filters(stage(proposed, "proposals"), max_words, most_bits)
    wanted = (F.col("f") >= min_count) | (F.col("size") == 0)
    found = stage(count_phrases(rows, max_words, None, first, held).where(wanted), "phrases")
    failed = stage(outside(found.where(F.col("size").between(1, max_words - 1)), first), "border-failures")
    if failed.isEmpty():
        return found
    now = build_filters(failed, max_words, most_bits, first)
    return found.unionByName(stage(count_phrases(rows, max_words, first, now, held).where(wanted), "phrases"))


def score_phrases(counts: DataFrame, *, max_words: int = 3, percent: int = 50) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words and more that no longer one stands for.

    A phrase is cut in two where its score floor(10**6 * a * a / (l * r)) is
    least, at the smaller first part if equal. It goes if a longer frequent
    phrase that holds it has ``percent`` in a hundred of its occurrences. All
    products are decimals of 38 digits.
    """
    longer = counts.where("size >= 2").select("lang", "size", "phrase", F.col("f").alias("a"))
    cut = longer.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    cut = cut.withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn("right", F.expr("substring_index(phrase, ' ', k - size)"))
    known = counts.where("size >= 1")
    left = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cut = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    score = F.expr(
        "(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    )
    best = cut.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    # the commonest longer phrase around each phrase
    parts = longer.where("size >= 3").select("lang", "size", "a", F.split("phrase", " ").alias("w"))
    parts = parts.withColumn("m", F.explode(F.expr("sequence(2, size - 1)"))).withColumn("at", F.explode(F.expr("sequence(1, size - m + 1)")))
    around = parts.groupBy("lang", F.array_join(F.slice("w", F.col("at"), F.col("m")), " ").alias("phrase")).agg(F.max("a").alias("most"))
    kept = best.join(around, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("most") < percent * F.col("a"), F.lit(True)))
    n = counts.where("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return kept.select("lang", "phrase", "a", "b.l", "b.r", "b.score").join(n, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, *, limit: int = 2000, min_count: int = 10, max_words: int = 3, percent: int = 50, **options) -> DataFrame:
    """The first ``limit`` phrases of each lang by score, count and phrase, with their rank."""
    scored = score_phrases(frequent_phrases(docs, min_count=min_count, max_words=max_words, **options), max_words=max_words, percent=percent)
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= limit)
