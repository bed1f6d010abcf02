"""Resampling towards a target distribution by importance of hashed word runs.

A dictionary of distinct words, each between two delimiters, is compiled into
an Aho-Corasick automaton; its payloads are the CRC-32 of a word and its length
in bytes. A scan of a text emits one payload per word, in order. The CRC of a
run of words follows from the payloads of its neighbours (a CRC of joined
strings is linear in the parts), so runs are never put together as strings.
CRCs give buckets, buckets are counted over all documents and all target texts,
and a document's weight is the sum of the gains of its buckets. The seeded
Gumbel draw takes the documents with the highest sums of weight and noise.

The dictionary holds the commonest words, at most ``size`` of at most 64
characters, so what is broadcast is bounded; the words between two payloads
that are not in it get the same payload from the word itself. The dictionary
thus decides how fast a scan is, never its result.

Nulls: a null text has no words, weight 0 and is never drawn; a null doc_id has
a null score and is never drawn, its words are counted. Equal rows are rows of
their own; equal scores go to the smaller doc_id. Texts of any length are
scanned whole. Empty tables give empty results or plain noise. More columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import stage
from .common import ascii_lower, ascii_lowered, spread_rows

DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DELIMITERS = re.compile(DELIMITERS)
#: Most words of a dictionary, and most characters of one of them.
DICTIONARY, LONGEST = 50_000, 64
_ROWS_PER_RANGE = 500_000


def bounded(text: str | None) -> str:
    """The words of a text, one delimiter (a space) around each."""
    return f" {_DELIMITERS.sub(' ', ascii_lowered(text or ''))} "


def dictionary(texts: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The commonest words of the column ``text``, at most ``size``, counted over all rows.

    Words are taken down to a count that lets no more than ``size`` through, so
    no more than that reaches the driver.
    """
    words = texts.select(F.explode(F.split(ascii_lower(F.col("text")), DELIMITERS)).alias("word"))
    words = words.where(F.char_length("word").between(1, LONGEST)).groupBy("word").agg(F.count("*").alias("n"))
    words = stage(words, "word-counts")
    # counts by their leading five bits: some hundred rows
    low = F.greatest(F.char_length(F.bin("n")) - 5, F.lit(0))
    grades = words.groupBy(F.call_function("shiftright", F.col("n"), low).alias("lead"), low.alias("low")).agg(F.count("*").alias("words")).collect()
    least, taken = None, 0
    for r in sorted(grades, key=lambda r: -(r["lead"] << r["low"])):
        taken += r["words"]
        if taken > size:
            break
        least = r["lead"] << r["low"]
    return [] if least is None else [r["word"] for r in words.where(F.col("n") >= least).select("word").collect()]


class Scanner:
    """The automaton of a dictionary and the payloads of its words."""

    def __init__(self, words: list[str]):
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        raw = [w.encode() for w in words]
        self.crc = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw))
        self.octets = np.fromiter(map(len, raw), np.int64, len(raw))
        self.chars = np.fromiter(map(len, words), np.int64, len(words))
        for number, word in enumerate(words):
            self.automaton.add_word(f" {word} ", number)
        if words:
            self.automaton.make_automaton()

    def payloads(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(CRC, bytes) of every word of a text, in order."""
        t = bounded(text)
        hits = list(self.automaton.iter(t)) if len(self.chars) else []
        ends, numbers = zip(*hits) if hits else ((), ())
        end, number = np.fromiter(ends, np.int64, len(ends)), np.fromiter(numbers, np.int64, len(numbers))
        begin = end - self.chars[number] - 1
        crc, octets = self.crc[number], self.octets[number]
        # neighbours share a delimiter; where the next payload begins later, words without one lie between
        last = np.concatenate([[0], end])
        gaps = np.flatnonzero(np.append(begin, len(t) - 1) > last)
        found = [(int(g), w) for g in gaps for w in t[last[g] : begin[g] + 1 if g < len(begin) else len(t)].split(" ") if w]
        if not found:
            return crc, octets
        raw, at = [w.encode() for _, w in found], [g for g, _ in found]
        more = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw)), np.fromiter(map(len, raw), np.int64, len(raw))
        return np.insert(crc, at, more[0]), np.insert(octets, at, more[1])


@lru_cache(maxsize=None)
def _power(k: int) -> np.ndarray:
    """Four tables of 256: what a CRC register becomes after 2**k bytes of zero."""
    if k == 0:
        one = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)
        return np.stack([one, *[np.arange(256, dtype=np.uint32) << (8 * b) for b in range(3)]])
    half = _power(k - 1)
    values = np.stack([np.arange(256, dtype=np.uint32) << (8 * b) for b in range(4)])
    return _lookup(half, _lookup(half, values))


def _lookup(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & 255] ^ tables[1][(x >> 8) & 255] ^ tables[2][(x >> 16) & 255] ^ tables[3][x >> 24]


def joined_crc(left: np.ndarray, right: np.ndarray, octets: np.ndarray) -> np.ndarray:
    """CRC of two strings one after the other, from their CRCs and the bytes of the right one."""
    out = left.copy()
    for k in range(int(octets.max(initial=0)).bit_length()):
        on = (octets >> k & 1).astype(bool)
        out[on] = _lookup(_power(k), out[on])
    return out ^ right


_SPACE = np.uint32(zlib.crc32(b" "))


def run_crcs(crc: np.ndarray, octets: np.ndarray, max_words: int) -> np.ndarray:
    """CRCs of all runs of 1 to ``max_words`` neighbours, words joined by one space."""
    runs, parts = crc, [crc]
    spaced = joined_crc(np.full(len(crc), _SPACE), crc, octets)  # " word"
    for n in range(2, max_words + 1):
        if len(crc) < n:
            break
        runs = joined_crc(runs[: len(crc) - n + 1], spaced[n - 1 :], octets[n - 1 :] + 1)
        parts.append(runs)
    return np.concatenate(parts)


_HELD: list = [None, None]


def _scanner(words: list[str]) -> Scanner:
    """The automaton of a dictionary, built once in each worker."""
    if _HELD[0] is not words:
        _HELD[:] = words, Scanner(words)
    return _HELD[1]


def bucketed(df: DataFrame, words: Broadcast, *, max_words: int, buckets: int) -> DataFrame:
    """(doc_id, n_words, buckets): the bucket of every run, as little-endian numbers."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(words.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, data = [], []
                for text in part.column("text"):
                    crc, octets = scan.payloads(text.as_py())
                    n.append(len(crc))
                    data.append((run_crcs(crc, octets, max_words) % np.uint32(buckets)).astype(kind).tobytes())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(data, pa.binary())], ["doc_id", "n_words", "buckets"])

    return df.select("doc_id", "text").mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, n_words long, buckets binary")


def bucket_counts(coded: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over all rows; a task sends at most one row for each bucket."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column(0):
                total += np.bincount(np.frombuffer(data.as_py(), kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["bucket", "n"])

    return coded.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln) of the target's share of each bucket over the documents' share, both smoothed by one."""
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(docs.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0)
    sums = both.agg(F.struct(F.sum("s").alias("s"), F.sum("t").alias("t")).alias("all"))
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    all_s, all_t = F.col("all.s").cast("double"), F.col("all.t").cast("double")
    ratio = (t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets))
    rows = both.withColumn("all", sums.scalar()).select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).collect()
    out = np.zeros(buckets, np.int64)  # one number for each bucket
    for r in rows:
        out[r["bucket"]] = r["gain"]
    return out


def weigh(coded: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): sum of the gains of all runs of a document."""
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"
    held = coded.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            slots = [np.frombuffer(b.as_py(), kind) for b in batch.column("buckets")]
            n, w = [len(x) for x in slots], [int(table[x].sum()) for x in slots]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(n, pa.int64()), pa.array(w, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    return coded.mapInArrow(run, f"doc_id {coded.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def draw(scored: DataFrame, percent: int) -> DataFrame:
    """Add ``rank`` 1, 2, 3 ... to the highest ``percent`` in a hundred of the rows marked ``eligible``.

    The rows are dealt out by ranges of (score, doc_id) and written, then
    ranked inside each range behind the rows of the ranges before it.
    """
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features")]
    scored = stage(scored, "scores")
    parts = min(4096, -(-max(scored.count(), 1) // _ROWS_PER_RANGE))
    ranged = stage(scored.repartitionByRange(parts, *order[:3]).withColumn("part", F.spark_partition_id()), "score-ranges")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"), F.count_if("eligible").alias("e"))
    upto = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # at most 4,096 rows
    before = sizes.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    wanted = sizes.agg(F.floor(F.sum("e") * percent / 100).cast("long").alias("wanted"))
    rank = F.col("before") + F.row_number().over(W.partitionBy("part").orderBy(*order))
    out = ranged.join(F.broadcast(before), "part").withColumn("rank", rank).withColumn("wanted", wanted.scalar())
    return out.withColumn("rank", F.when(F.col("eligible") & (F.col("rank") <= F.col("wanted")), F.col("rank"))).drop("wanted", "before", "part")


def resample(
    docs: DataFrame, target: DataFrame, *, max_words: int = 1, buckets: int = 10_000, least_words: int = 20, percent: int = 10,
    seed: int = 2024, size: int = DICTIONARY,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document.

    ``docs`` has doc_id and text, ``target`` a text. Drawn are the highest
    scores, ``percent`` in a hundred of the documents of at least
    ``least_words`` words; the others have a null rank.
    """
    docs = spread_rows(docs.select("doc_id", "text"))
    goal = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    words = docs.sparkSession.sparkContext.broadcast(dictionary(docs.select("text").union(goal.select("text")), size))
    coded = stage(bucketed(docs, words, max_words=max_words, buckets=buckets), "buckets")
    gain = gains(bucket_counts(coded, buckets), bucket_counts(bucketed(goal, words, max_words=max_words, buckets=buckets), buckets), buckets)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = weigh(coded, gain).withColumn("score", F.col("weight") + noise)
    scored = scored.withColumn("eligible", (F.col("n_words") >= least_words) & F.col("score").isNotNull())
    return draw(scored, percent).drop("eligible")
