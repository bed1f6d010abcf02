"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of hash pairs are computed; the keys of the tables are
all combinations of one pair of each, so 48 hashes serve 144 tables of four
hashes, and two documents of similarity 0.75 share a table but for about one
case in ten thousand. Links are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .components import components

WIDTH = 5  # words of a shingle
PAIRS = 12  # hash pairs of each collection
HASHES = 4 * PAIRS
PARTNERS = 3  # comparisons of a class in a round
BLOCK = 1024  # classes of a table that meet in a task
TILE = 256
_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = _RNG.integers(1, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text.

    Words are runs outside ASCII white space, A-Z in lower case. A text of
    fewer than five words is one shingle; one without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if not len(h):
        return h
    if len(h) < WIDTH:
        sums = np.array([(h * _STEPS[: len(h)]).sum() + np.uint64(len(h))], np.uint64)
    else:
        sums = sum(h[k : len(h) - WIDTH + 1 + k] * _STEPS[k] for k in range(WIDTH))
    sums ^= sums >> np.uint64(31)
    sums *= np.uint64(0x9FB21C651E98DF25)
    sums ^= sums >> np.uint64(32)
    return np.unique(sums)


def minhashes(found: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        np.minimum(best, np.multiply.outer(_FACTORS, found[at : at + 2048]).min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signatures(df: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_id, sig) of (doc_id, text); no set_id where there are no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, names, sigs = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                counts.append(len(found))
                names.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sigs.append(minhashes(found) if len(found) else None)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(names, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_id", "sig"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, set_id binary, sig array<int>")


def shingle_sets(df: DataFrame) -> DataFrame:
    """(rep, set, small) of (rep, text): the sorted shingle hashes, and 16 bits of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [shingles(t) for t in part.column("text").to_pylist()]
                sets = pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))
                small = pa.array([(x >> np.uint64(20)).astype(np.uint16).tobytes() for x in found], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("rep"), sets, small], ["rep", "set", "small"])

    return df.mapInArrow(run, "rep long, set array<long>, small binary")


def shared_pairs(classes: DataFrame) -> DataFrame:
    """(rep, side, number, half): the hash pairs that a class shares with another."""
    at = lambda i: F.get("sig", F.lit(i))
    half = lambda i: F.struct(F.lit(i).alias("number"), F.xxhash64(F.lit(i), at(2 * i), at(2 * i + 1)).alias("half"))
    halves = classes.select("rep", F.explode(F.array(*map(half, range(2 * PAIRS)))).alias("h")).select("rep", "h.number", "h.half")
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    return halves.join(shared, "half").select("rep", (F.col("number") >= PAIRS).alias("second"), "number", "half")


def tables(shared: DataFrame) -> DataFrame:
    """(rep, key): the tensored table keys, one for each combination of shared pairs."""
    side = lambda s: F.collect_list(F.when(F.col("second") == s, F.col("half")))
    sides = shared.groupBy("rep").agg(side(False).alias("s0"), side(True).alias("s1"))
    return sides.select("rep", F.explode("s0").alias("a"), "s1").select("rep", "a", F.explode("s1").alias("b")).select("rep", F.xxhash64("a", "b").alias("key"))


def likely(left: pd.DataFrame, right: pd.DataFrame | None, number: int) -> list[tuple[int, int]]:
    """Pairs of one table of the first collection whose similarity may be 0.75.

    ``right`` None stands for the pairs within ``left``. A pair must share a
    hash pair of the second collection too, belong to different components,
    and share no earlier table of the first (it is looked at there). What is
    left is bounded by the overlap of 16-bit hashes, which is never too small.
    """
    out: list[tuple[int, int]] = []
    one = lambda t: (t["rep"].to_numpy(), t["comp"].to_numpy(), t["n"].to_numpy(), np.ascontiguousarray(np.stack(t["sig"].to_numpy()).astype(np.int32)).view(np.int64))
    rep_x, comp_x, n_x, half_x = one(left)
    rep_y, comp_y, n_y, half_y = (rep_x, comp_x, n_x, half_x) if right is None else one(right)
    sets_x = [np.frombuffer(v, np.uint16) for v in left["small"]]
    sets_y = sets_x if right is None else [np.frombuffer(v, np.uint16) for v in right["small"]]
    seen = np.zeros(1 << 16, bool)
    for lo in range(0, len(rep_x), TILE):
        x = slice(lo, lo + TILE)
        flat, size = np.concatenate(sets_x[x]), np.array([len(v) for v in sets_x[x]])
        start = np.r_[0, np.cumsum(size)[:-1]]
        for low in range(0 if right is not None else lo, len(rep_y), TILE):
            y = slice(low, low + TILE)
            may = (comp_x[x, None] != comp_y[None, y]) & (4 * np.minimum(n_x[x, None], n_y[None, y]) >= 3 * np.maximum(n_x[x, None], n_y[None, y]))
            if right is None:
                may &= rep_x[x, None] < rep_y[None, y] if lo != low else np.triu(np.ones(may.shape, bool), 1)
            same = np.zeros(may.shape, bool)
            for k in range(PAIRS, 2 * PAIRS):
                same |= half_x[x, k][:, None] == half_y[None, y, k]
            may &= same
            for k in range(number):
                may &= half_x[x, k][:, None] != half_y[None, y, k]
            for j in np.flatnonzero(may.any(axis=0)):
                rows = np.flatnonzero(may[:, j])
                seen[sets_y[low + j]] = True
                if len(rows) * 16 > len(size):
                    most = np.add.reduceat(seen[flat], start, dtype=np.int64)[rows]
                else:
                    most = np.array([int(seen[sets_x[lo + i]].sum()) for i in rows])
                seen[sets_y[low + j]] = False
                good = rows[100 * most >= 75 * (n_x[lo + rows] + n_y[low + j] - most)]
                out += [(int(rep_x[lo + i]), int(rep_y[low + j])) for i in good]
    return out


def remaining(keys: DataFrame, known: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b): likely links between different components, each pair of documents once.

    ``keys`` is (rep, number, half): the shared hash pairs of the first
    collection. Tables with one component are done. The others are cut into
    blocks, and every two blocks meet in a task.
    """
    rows = keys.join(labels, "rep")
    open_ = rows.groupBy("number", "half").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("all")).where("lo <> hi")
    blocks = F.ceil(F.col("all") / BLOCK).cast("int")
    rows = rows.join(open_.select("number", "half", blocks.alias("blocks")), ["number", "half"])
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("rep", "comp", "number", "half", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own").join(known, "rep")

    def meet(t: pd.DataFrame) -> pd.DataFrame:
        x, y, number = int(t["x"].iloc[0]), int(t["y"].iloc[0]), int(t["number"].iloc[0])
        t = t.sort_values("rep")
        pairs = likely(t, None, number) if x == y else likely(t[t["own"] == x], t[t["own"] == y], number) if t["own"].nunique() == 2 else []
        return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

    return rows.groupBy("number", "half", "x", "y").applyInPandas(meet, "a long, b long")


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= 75 * union of their sets."""
    first = pairs.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("x")), "a")
    both = first.join(sets.select(F.col("rep").alias("b"), F.col("set").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y")).cast("long")
    return both.where(100 * common >= 75 * (F.size("x") + F.size("y") - common)).select("a", "b")


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after joining the components that the links connect."""
    of = lambda c: labels.select(F.col("rep").alias(c), F.col("comp").alias(f"c{c}"))
    edges = links.join(of("a"), "a").join(of("b"), "b").select(F.col("ca").alias("u"), F.col("cb").alias("v"))
    roots = components(edges).withColumnRenamed("node", "comp")
    return stage(labels.join(roots, "comp", "left").select("rep", F.coalesce("root", "comp").alias("comp")), "near-labels")


def near_duplicates(df: DataFrame, rounds: int = 6) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of (doc_id, text).

    Documents with equal sets are one class. First, every class is compared
    with the nearest pivots of its tables, others each round, and linked
    classes join; a large group of near copies so becomes one component with
    a few comparisons per document. Then the pairs that share a table and are
    not yet in one component are all tested, in blocks (``remaining``): a bound
    first, the full sets after it. No table is capped.

    Without words or text a document has no shingles and is alone. A null
    doc_id is alone, with a null component, and kept. Equal rows are in one
    component; ``kept`` marks each row that carries the smallest id.
    """
    sigs = stage(signatures(df), "near-signatures")
    classes = stage(
        sigs.where("set_id is not null and doc_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")),
        "near-classes",
    )
    shared = stage(shared_pairs(classes), "near-shared")
    keys = stage(tables(shared), "near-tables")
    members = keys.select("rep").distinct()
    text = df.select(F.col("doc_id").cast("long").alias("rep"), "text").join(members, "rep", "left_semi")
    sets = stage(shingle_sets(text), "near-sets")
    labels = stage(members.withColumn("comp", F.col("rep")), "near-labels")

    for r in range(rounds):
        rows = keys.join(labels, "rep")
        best = F.min(F.struct(F.xxhash64(F.lit(r), "rep").alias("h"), F.col("rep").alias("pivot"), F.col("comp").alias("pc"))).alias("p")
        pivots = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), best).where("lo <> hi").select("key", "p.pivot", "p.pc")
        met = rows.join(pivots, "key").where("comp <> pc").groupBy("rep", "pivot").count()
        # the pivots that share most tables with a class; a class has at most one pivot per table
        most = F.slice(F.sort_array(F.collect_list(F.struct("count", "pivot")), asc=False), 1, PARTNERS)
        pairs = met.groupBy("rep").agg(most.alias("m")).select(F.col("rep").alias("a"), F.explode("m.pivot").alias("b"))
        links = stage(confirm(pairs, sets), "near-links")
        if links.isEmpty():
            break
        labels = _merge(labels, links)

    known = classes.select("rep", "n", "sig").join(sets.select("rep", "small"), "rep")
    pairs = stage(remaining(shared.where("not second").select("rep", "number", "half"), known, labels), "near-pairs")
    links = stage(confirm(pairs, sets), "near-links")
    if not links.isEmpty():
        labels = _merge(labels, links)

    of_set = classes.select("set_id", "rep").join(labels, "rep", "left").select("set_id", F.coalesce("comp", "rep").alias("comp"))
    got = sigs.select("doc_id", "n_shingles", "set_id").join(of_set, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return got.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
