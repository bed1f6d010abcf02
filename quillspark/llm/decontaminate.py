"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item is cut into windows of consecutive words. A document holds a window
only if it holds each of the window's shingles, so one of them is enough to
look for: shingles are ordered by how often they occur in the documents, and
the rarest of each window, its necessary prefix, is joined with the shingles of
the documents. A match fixes where the window would begin; matches that would
begin before the text or end behind it are dropped, the others are verified
word by word.

Nulls: a null text has no words; a null doc_id is kept as it is, a null item_id
counts as an item with an empty name. Items without words have no window. Items
of equal id are one item with the windows of all its rows. Equal documents get
equal results, each row its own. Texts of any length are cut up whole. Tables
may be empty and may have more columns; only those named are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import stage
from .common import ascii_lower, spread_rows

#: Words: runs of ASCII letters and digits and of all characters beyond ASCII.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Tables of item windows up to this estimate are broadcast, larger ones are shuffled.
BROADCAST_BYTES = 32 << 20


def word_list(text: Column) -> Column:
    """All words of a text in order, A-Z in small letters."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def item_windows(items: DataFrame, size: int, *, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, ws): the windows of ``size`` words of each item; a shorter item is one window."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), word_list(F.col(text)).alias("w"))
    rows = rows.where(F.size("w") > 0)
    first = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1))))
    return rows.select("item", "w", first.alias("at")).select("item", F.slice("w", F.col("at"), F.lit(size)).alias("ws")).distinct()


def _key(words: str, at: Column, n: int) -> Column:
    """The number of the shingle of ``n`` words at a place (from 0)."""
    return F.xxhash64(F.lit(n), *[F.get(words, at + i) for i in range(n)])


def _positions(rows: DataFrame, sizes: Sequence[int], *keep: str) -> DataFrame:
    """(keep, pos, key): a row per place of a text and shingle size."""
    at = rows.select(*keep, "words", F.posexplode("words").alias("pos", "_word"))
    keys = [F.xxhash64(F.lit(n), "_word", *[F.get("words", F.col("pos") + i) for i in range(1, n)]) for n in sizes]
    kept = [c for c in keep if c != "words"]
    return at.select(*kept, "words", "pos", (keys[0] if len(keys) == 1 else F.explode(F.array(*keys))).alias("key"))


def _bytes(df: DataFrame, *arrays: str) -> int:
    text = [F.octet_length(F.concat_ws(" ", a)) for a in arrays]
    got = df.agg(F.sum(sum(text, F.lit(200)))).first()[0]
    return got or 0


def occurrences(
    rows: DataFrame, windows: DataFrame, *, shingle: int = 3, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(row, start, end, win): every place where a window stands in a text.

    ``rows`` is (row, words), ``windows`` (win, ws). A window shorter than a
    shingle is its own shingle.
    """
    sizes = sorted(r[0] for r in windows.select(F.least(F.size("ws"), F.lit(shingle))).distinct().collect())
    if not sizes:
        return rows.select("row", F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(0).cast("long").alias("win")).limit(0)
    small = _bytes(windows, "ws") <= broadcast_bytes

    def hint(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    # all shingles of the windows, and how often the documents hold them
    n = F.size("ws")
    inside = windows.select("win", "ws", F.explode(F.sequence(F.lit(0), F.greatest(n - shingle, F.lit(0)))).alias("off"))
    key = F.coalesce(*[F.when(F.least(n, F.lit(shingle)) == s, _key("ws", F.col("off"), s)) for s in sizes])
    shingles = stage(inside.select("win", "off", key.alias("key")), "window-shingles")
    held = _positions(rows, sizes, "row").select("key")
    known = shingles.select("key").distinct()
    counts = (held.join(hint(known), "key") if small else held).groupBy("key").agg(F.count("*").alias("n"))
    # windows of which one shingle occurs nowhere are gone; the rarest shingle stands for each of the others
    ranked = shingles.join(counts, "key", "left").groupBy("win").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "off")).alias("p")
    )
    prefix = stage(ranked.where("p.n > 0").select("win", "p.key", "p.off").join(windows, "win"), "window-prefixes")
    start, n = F.col("pos") - F.col("off"), F.size("ws")
    fits = (start >= 0) & (start + n <= F.size("words"))
    same = F.slice("words", start + 1, n) == F.col("ws")
    out = ["row", start.alias("start"), (start + n).alias("end"), "win"]
    if small:
        met = _positions(rows, sizes, "row").join(F.broadcast(prefix), "key")
        return met.where(fits).where(same).select(*out)
    # windows beyond the bound: only places meet in the shuffle, texts join the places that are left
    places = _positions(rows.withColumn("total", F.size("words")), sizes, "row", "total").select("row", "total", "pos", "key")
    met = places.join(prefix.select("key", "off", "win", F.size("ws").alias("n")), "key")
    met = met.where((start >= 0) & (start + F.col("n") <= F.col("total"))).select("row", "pos", "off", "win")
    return met.join(prefix.select("win", "ws"), "win").join(rows, "row").where(same).select(*out)


def merged(found: DataFrame) -> DataFrame:
    """(row, spans): places as spans of words that neither overlap nor touch, in order."""
    order = W.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    places = found.select("row", "start", "end").distinct().withColumn("new", F.coalesce((F.col("start") > before).cast("int"), F.lit(1)))
    islands = places.withColumn("island", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    spans = islands.groupBy("row", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def find_contamination(
    docs: DataFrame, items: DataFrame, *, size: int = 10, shingle: int = 3, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(doc_id, n_words, spans, items) for every document.

    ``spans`` are the stretches [start, end) of words that belong to some
    window, ``items`` the sorted ids (as strings) of the items with a window in
    the document; both are empty for a clean one.
    """
    # the words are cut once; the written row number tells rows of equal ids apart
    rows = spread_rows(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")))
    rows = stage(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", word_list(F.col("_text")).alias("words")), "words")
    owned = stage(item_windows(items, size, item_id=item_id, text=item_text), "item-windows")
    windows = stage(owned.select("ws").distinct().withColumn("win", F.monotonically_increasing_id()), "windows")
    found = occurrences(rows.select("row", "words"), windows, shingle=shingle, broadcast_bytes=broadcast_bytes)
    found = stage(found, "occurrences")
    owners = owned.join(windows, "ws").select("win", "item").distinct()
    if _bytes(owners.select(F.array("item").alias("item")), "item") <= broadcast_bytes:
        owners = F.broadcast(owners)
    held = found.select("row", "win").distinct().join(owners, "win").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    hits = merged(found).join(held, "row")
    out = rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words")).join(hits, "row", "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias("spans"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
    )
