"""Exact nearest neighbours of many rows without comparing all pairs.

Vectors are scaled to unit length, where a larger cosine is a smaller distance
and the triangle inequality holds. Every distinct vector of the corpus belongs
to the cell of its nearest pivot. A query first meets one block of its own cell,
which bounds the distance of its k-th neighbour; it is then sent only to those
cells that can hold anything as near, by three bounds: the plane between its
nearest pivot and the cell's, and the least and the largest distance of the
cell's rows from their pivot. Cells larger than a block are cut into blocks;
blocks of cells that lie together form a tile. A query goes to a tile once, with
the blocks it has to meet, and a task holds one tile and as many queries as a
tile has rows. Products are taken in single precision, and what can be among the
best within their error is taken again in double precision.

Rows of equal direction are one vector with its smallest ids, so a group of
copies, however large, is compared once. Pivots and the size and radii of the
cells are all that reaches the driver; both have a bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .ranking import top_n

BLOCK_ROWS = 8192  # rows of one side of a block product
ROWS_PER_CELL = 4096
MAX_PIVOTS = 1024
MAX_CELLS = 200_000  # cells of all groups; beyond, a group is one cell
MAX_UNITS = 62  # blocks of one tile, a bit each
TILE_BYTES = 16 << 20  # of the vectors of a tile, if that is more than a block
_ROUTED = 1024  # queries sent out at once: each can become a row for every tile of its group
_TOGETHER = 512  # queries of one product
_EXACT = 1 << 22  # components of products taken again at once
_DIGITS = 9  # similarities that agree to here are ties, broken by id
_SLACK = 1e-8  # of squared distances: rounding to those digits and floating point
_HITS = "qn long, ids array<long>, similarity double"


@dataclass
class Report:
    """What a join compared, against the pairs it stands for."""

    pairs: int = 0
    compared: int = 0


def usable(vector: str) -> Column:
    """Not null, not empty, without null or non-finite components."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True))


def directions(df: DataFrame) -> DataFrame:
    """(g, dim, id, u, zero) of (g, id, v): vectors as bytes, scaled by a power of two so that the largest component is in [0.5, 1). Floats stay floats: what this can lose is 2^-149 of the largest component."""
    kind = np.float32 if df.schema["v"].dataType.elementType.simpleString() == "float" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dim, out, zero = b.column("dim").to_numpy(), np.empty(b.num_rows, object), np.zeros(b.num_rows, bool)
            for d in np.unique(dim):
                at = np.flatnonzero(dim == d)
                x = b.column("v").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), d)
                top = np.abs(x).max(axis=1)
                near = np.ldexp(x, -np.frexp(top)[1][:, None]).astype(kind) + kind(0)  # no -0.0
                out[at], zero[at] = [row.tobytes() for row in near], top == 0
            yield pa.RecordBatch.from_arrays([b.column("g"), b.column("dim"), b.column("id"), pa.array(out, pa.binary()), pa.array(zero, pa.bool_())], ["g", "dim", "id", "u", "zero"])

    g = df.schema["g"].dataType.simpleString()
    return df.select("g", F.size("v").alias("dim"), "id", "v").mapInArrow(run, f"g {g}, dim int, id long, u binary, zero boolean")


def _matrix(column: pa.Array | list[bytes], dim: int) -> np.ndarray:
    """Unit vectors of ``directions`` of one length. A zero vector gets one more dimension of its own, so that its cosine with all others is 0."""
    held = column if isinstance(column, list) else column.to_pylist()
    if not held:
        return np.zeros((0, dim + 1))
    m = np.frombuffer(b"".join(held), np.float32 if len(held[0]) == 4 * dim else np.float64).reshape(len(held), dim).astype(np.float64)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.concatenate([np.divide(m, n, out=m, where=n > 0), n == 0], axis=1)


def _distances(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (m @ pivots.T)))


def _with_cell(df: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds the nearest pivot and its distance."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dim = b.column("dim").to_numpy()
            cell, r = np.zeros(len(dim), np.int32), np.zeros(len(dim))
            for d in np.unique(dim):
                at = np.flatnonzero(dim == d)
                gap = _distances(_matrix(b.column("u").take(pa.array(at)), d), shared.value[d])
                cell[at] = gap.argmin(axis=1)
                r[at] = gap.min(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(r)], [*b.schema.names, "cell", "r"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kept}, cell int, r double")


def _best(
    q: np.ndarray, c: np.ndarray, c4: np.ndarray, first_id: np.ndarray, least: np.ndarray, mask: np.ndarray, units: list[tuple[int, int, int]], k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, similarity) of the k best columns of each row at or above ``least``, ties by id.

    ``c4`` is ``c`` in single precision. ``units`` are (bit, from, to) of the columns; a row meets those whose bit is in its ``mask``. The bound of a row rises
    from one unit to the next, so that few products have to be taken in double precision.
    """
    q4 = q.astype(np.float32)
    slack = (q.shape[1] + 8) * 2.0**-23 + 10.0**-_DIGITS  # error of a product in single precision, and rounding
    low = least.copy()
    rows, cols, sims = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(r: np.ndarray, x: np.ndarray) -> None:
        nonlocal rows, cols, sims
        exact = np.round(np.einsum("ij,ij->i", q[r], c[x]), _DIGITS)
        keep = exact >= low[r]
        rows, cols, sims = np.concatenate([rows, r[keep]]), np.concatenate([cols, x[keep]]), np.concatenate([sims, exact[keep]])
        order = np.lexsort((first_id[cols], -sims, rows))
        rows, cols, sims = rows[order], cols[order], sims[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        full = place == k - 1
        low[rows[full]] = np.maximum(low[rows[full]], sims[full])
        rows, cols, sims = rows[place < k], cols[place < k], sims[place < k]

    for bit, start, end in units:
        meets = np.flatnonzero(mask >> bit & 1)
        if not len(meets):
            continue
        left = q4 if len(meets) == len(q) else q4[meets]
        for first in range(start, end, BLOCK_ROWS):
            s = left @ c4[first : min(end, first + BLOCK_ROWS)].T
            hit = s >= (low[meets] - slack).astype(np.float32)[:, None]
            many = np.flatnonzero(np.count_nonzero(hit, axis=1) > 4 * k)
            if len(many):  # no bound yet, or a low one: the k-th of these columns is one
                edge = np.partition(s[many], s.shape[1] - k, axis=1)[:, s.shape[1] - k]
                hit[many] = s[many] >= (edge - 2 * slack).astype(np.float32)[:, None]
            at = np.flatnonzero(hit)
            step = max(1, _EXACT // q.shape[1])
            for i in range(0, len(at), step):
                part = at[i : i + step]
                add(meets[part // s.shape[1]], first + part % s.shape[1])
    return rows, cols, sims


def _meet(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Hits of queries and corpus rows with equal (g, dim, tile, part), for those blocks of the tile that are in the query's mask."""
    keys = ["g", "dim", "tile", "part"]

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"qn": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())), "similarity": pa.array([], pa.float64())})
        left, right = left.sort_by("mask"), right.sort_by("bit")
        dim = left.column("dim")[0].as_py()
        q, c = (_matrix(t.column("u").combine_chunks(), dim) for t in (left, right))
        ids = right.column("ids").combine_chunks()
        first = np.array([x[0].as_py() for x in ids], np.int64)
        bits, starts = np.unique(right.column("bit").to_numpy(), return_index=True)
        units = list(zip(bits.tolist(), starts.tolist(), [*starts[1:].tolist(), len(c)]))
        least, qn, mask = (left.column(x).to_numpy() for x in ("least", "qn", "mask"))
        c4, out = c.astype(np.float32), []
        for i in range(0, len(q), _TOGETHER):
            rows, cols, s = _best(q[i : i + _TOGETHER], c, c4, first, least[i : i + _TOGETHER], mask[i : i + _TOGETHER], units, k)
            out.append(pa.table({"qn": qn[i + rows], "ids": ids.take(pa.array(cols)).cast(pa.list_(pa.int64())), "similarity": s}))
        return pa.concat_tables(out)

    return queries.groupBy(*keys).cogroup(corpus.groupBy(*keys)).applyInArrow(one, _HITS)


def knn_join(
    queries: DataFrame, corpus: DataFrame, k: int, *, exclude_self: bool = True, rows_per_cell: int = ROWS_PER_CELL, block: int = BLOCK_ROWS,
    report: Report | None = None,
) -> DataFrame:
    """(query_id, rank, neighbor_id, similarity): the k nearest corpus rows of each query in its group.

    Both sides are (g, id, v). Rows compare only with rows of equal g (NULL
    equals NULL) and length; rows without a usable vector take no part.
    Similarities are rounded to nine digits; equal ones go to the smaller id.
    """
    kk = k + 1 if exclude_self else k
    all_q = stage(directions(queries.where(usable("v"))), "knn-queries")
    q_rows = all_q.where(~F.col("zero"))
    c_rows = directions(corpus.where(usable("v")))
    c_ids = corpus.where(usable("v")).select("g", F.size("v").alias("dim"), F.col("id").alias("neighbor_id"))
    few = top_n(c_rows, ["g", "dim", "u"], ["id"], kk).groupBy("g", "dim", "u").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    c = stage(few, "knn-corpus")
    q = stage(q_rows.select("g", "dim", "u").distinct().withColumn("qn", F.monotonically_increasing_id()), "knn-distinct")

    sizes = {r["dim"]: r["n"] for r in c.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row for each length of vectors
    groups = max(1, c.select("g", "dim").distinct().count())
    wanted = {d: 1 if groups * MAX_PIVOTS > MAX_CELLS else int(np.clip(n // rows_per_cell, 1, MAX_PIVOTS)) for d, n in sizes.items()}
    pivots = {}
    for d, n in wanted.items():
        some = c.where(F.col("dim") == d).select("u").distinct().orderBy(F.xxhash64("u"), "u").limit(n).collect()
        pivots[d] = _matrix([r["u"] for r in some], d)
    q = q.where(F.col("dim").isin(list(sizes)))
    c = stage(_with_cell(c, pivots), "knn-cells")
    cells = c.groupBy("g", "dim", "cell").agg(F.count("*").alias("n"), F.min("r").alias("inner"), F.max("r").alias("outer"))
    if all(n == 1 for n in wanted.values()):  # one cell a group: every query meets all of it, in blocks of a tile
        blocks = F.ceil(F.col("n") / _tile_rows(F.col("dim"), F.col("n"), block)).cast("int")
        cells = stage(cells.withColumn("blocks", blocks), "knn-sizes")
        sent = q.join(_null_safe_keys(cells, "n", "blocks"), _same(q, "g", "dim")).select(q["g"], q["dim"], "qn", "u", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("tile"), "n", "blocks")
        tiled = _attach(c, cells.select("g", "dim", "cell", "blocks"), ["g", "dim", "cell"])
        tiled = tiled.select("g", "dim", "u", "ids", F.pmod(F.xxhash64("u"), F.col("blocks")).cast("int").alias("tile"), F.lit(0).alias("bit"))
        hits = _run(sent.withColumn("least", F.lit(-2.0)).withColumn("mask", F.lit(1).cast("long")), tiled, kk, block)
        if report is not None:
            report.compared = sent.agg(F.sum(F.col("n") / F.col("blocks"))).first()[0] or 0
    else:
        cells = stage(cells.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "knn-sizes")
        plan = _plan(cells.collect(), pivots, block)  # at most MAX_CELLS rows
        tiled = _with_tile(c, plan)
        near = stage(_route(q.withColumn("least", F.lit(-2.0)).withColumn("met", F.lit(-1)), pivots, plan, first=True), "knn-near")
        met = stage(_run(near, tiled, kk, block), "knn-hits")  # at most kk rows a query, from one task
        edge = met.groupBy("qn").agg(F.when(F.count("*") == kk, F.min("similarity")).otherwise(F.lit(-2.0)).alias("least"))
        again = near.select("g", "dim", "qn", "u", "met").join(edge, "qn", "left").withColumn("least", F.coalesce("least", F.lit(-2.0)))
        far = stage(_route(again, pivots, plan, first=False), "knn-far")
        hits = met.unionByName(_run(far, tiled, kk, block))
        if report is not None:
            report.compared = sum(int(t.agg(F.sum("rows")).first()[0] or 0) for t in (near, far))
    if report is not None:
        report.pairs = int(q.groupBy("g", "dim").agg(F.count("*").alias("a")).join(_null_safe_keys(cells.groupBy("g", "dim").agg(F.sum("n").alias("n")), "n"), _same(q, "g", "dim")).agg(F.sum(F.col("a") * F.col("n"))).first()[0] or 0)
    rows = hits.select("qn", "similarity", F.explode("ids").alias("neighbor_id"))
    best = top_n(rows, ["qn"], [F.desc("similarity"), F.asc("neighbor_id")], kk).drop("rank")
    numbers = q.select(F.col("g").alias("_g"), F.col("dim").alias("_dim"), F.col("u").alias("_u"), "qn")
    owners = q_rows.join(numbers, q_rows["g"].eqNullSafe(F.col("_g")) & (q_rows["dim"] == F.col("_dim")) & (q_rows["u"] == F.col("_u"))).select("id", "qn")
    out = owners.join(best, "qn").select(F.col("id").alias("query_id"), "neighbor_id", "similarity")
    # a zero vector is as far from all rows as from each: its neighbours are the smallest ids
    least = top_n(c_ids, ["g", "dim"], ["neighbor_id"], kk).select(F.col("g").alias("_g"), F.col("dim").alias("_dim"), "neighbor_id")
    nowhere = all_q.where("zero")
    out = out.unionByName(nowhere.join(least, _same(nowhere, "g", "dim")).select(F.col("id").alias("query_id"), "neighbor_id", F.lit(0.0).alias("similarity")))
    if exclude_self:
        out = out.where("query_id <> neighbor_id")
    out = top_n(out, ["query_id"], [F.desc("similarity"), F.asc("neighbor_id")], k)
    return out.select("query_id", "rank", "neighbor_id", "similarity")


def _null_safe_keys(df: DataFrame, *values: str) -> DataFrame:
    return df.select(F.col("g").alias("_g"), F.col("dim").alias("_dim"), *values)


def _same(df: DataFrame, *keys: str) -> Column:
    return df["g"].eqNullSafe(F.col("_g")) & (df["dim"] == F.col("_dim"))


def _tile_rows(dim, rows, block: int):
    """Rows of a tile, of numbers or columns: a block or TILE_BYTES, at most eight blocks and, beyond a block, a fifth of all rows."""
    least, most, whole = (F.least, F.greatest, F.floor) if isinstance(dim, Column) else (min, max, int)
    number = F.lit if isinstance(dim, Column) else int
    return most(number(block), least(number(8 * block), whole(TILE_BYTES / (8 * dim)), whole(rows / 5)))


def _plan(cells: list, pivots: dict[int, np.ndarray], block: int) -> dict:
    """By (g, dim): cells with their number of rows and radii, the blocks of each ("units"), and the tile and bit of each unit.

    Cells are laid along a chain of nearest pivots, so that a tile holds cells that lie together.
    """
    held: dict = {}
    for r in cells:
        held.setdefault((r["g"], r["dim"]), []).append((r["cell"], r["n"], r["inner"], r["outer"], r["blocks"]))
    plan = {}
    for (g, d), rows in held.items():
        cell, n, inner, outer, blocks = (np.array(x) for x in zip(*rows))
        gaps, chain, left = _distances(pivots[d][cell], pivots[d][cell]), [0], np.ones(len(cell), bool)
        left[0] = False
        while left.any():
            chain.append(int(np.where(left, gaps[chain[-1]], np.inf).argmin()))
            left[chain[-1]] = False
        cell, n, inner, outer, blocks = (x[chain] for x in (cell, n, inner, outer, blocks))
        of = np.repeat(np.arange(len(cell)), blocks)  # the cell of a unit
        rows_of, most = -(-n // blocks)[of], _tile_rows(d, int(n.sum()), block)
        tile, bit, filled = np.zeros(len(of), np.int32), np.zeros(len(of), np.int32), 0
        for u in range(1, len(of)):
            filled += rows_of[u - 1]
            fits = filled + rows_of[u] <= most and bit[u - 1] + 1 < MAX_UNITS
            tile[u], bit[u], filled = (tile[u - 1], bit[u - 1] + 1, filled) if fits else (tile[u - 1] + 1, 0, 0)
        plan[g, d] = {"cell": cell, "inner": inner, "outer": outer, "blocks": blocks, "start": np.cumsum(blocks) - blocks, "of": of, "rows": rows_of, "tile": tile, "bit": bit}
    return plan


def _by_group(b: pa.RecordBatch) -> dict:
    """Places of the rows of each (g, dim)."""
    at: dict = {}
    for i, key in enumerate(zip(b.column("g").to_pylist(), b.column("dim").to_pylist())):
        at.setdefault(key, []).append(i)
    return {key: np.array(rows) for key, rows in at.items()}


def _with_tile(corpus: DataFrame, plan: dict) -> DataFrame:
    """Adds the tile and the bit in it of a row's unit."""
    shared = corpus.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tile, bit = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, np.int32)
            cells, chance = b.column("cell").to_numpy(), b.column("chance").to_numpy()
            for key, at in _by_group(b).items():
                p = shared.value[key]
                order = np.argsort(p["cell"])
                mine = order[np.searchsorted(p["cell"][order], cells[at])]
                unit = p["start"][mine] + chance[at] % p["blocks"][mine]
                tile[at], bit[at] = p["tile"][unit], p["bit"][unit]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in ("g", "dim", "u", "ids")), pa.array(tile), pa.array(bit)], ["g", "dim", "u", "ids", "tile", "bit"])

    g = corpus.schema["g"].dataType.simpleString()
    rows = corpus.select("g", "dim", "u", "ids", "cell", F.pmod(F.xxhash64("u"), F.lit(1 << 40)).alias("chance"))
    return rows.mapInArrow(run, f"g {g}, dim int, u binary, ids array<long>, tile int, bit int")


def _route(queries: DataFrame, pivots: dict[int, np.ndarray], plan: dict, *, first: bool) -> DataFrame:
    """A row per query and tile with a mask of the blocks to meet: one block of the nearest cell, or all others that can hold a neighbour."""
    shared = queries.sparkSession.sparkContext.broadcast((pivots, plan, {d: _distances(p, p) for d, p in pivots.items()}))
    names = ["g", "dim", "qn", "u", "least"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, plans, between = shared.value
        for b in (x.slice(start, _ROUTED) for x in batches for start in range(0, x.num_rows, _ROUTED)):
            least, met = b.column("least").to_numpy(), b.column("met").to_numpy()
            for (g, d), at in _by_group(b).items():
                if (g, d) not in plans:
                    continue
                p = plans[g, d]
                gap = _distances(_matrix(b.column("u").take(pa.array(at)), d), points[d])
                mine = gap[:, p["cell"]]
                if first:
                    j = mine.argmin(axis=1)
                    unit = p["start"][j] + at % p["blocks"][j]
                    yield sent(b, at, p["tile"][unit], np.int64(1) << p["bit"][unit].astype(np.int64), p["rows"][unit], unit)
                    continue
                home = gap.argmin(axis=1)
                apart = between[d][home][:, p["cell"]]
                plane = np.where(apart > 0, (mine**2 - (gap[np.arange(len(at)), home] ** 2)[:, None]) / np.where(apart > 0, 2 * apart, 1.0), 0.0)
                bound = np.maximum(np.maximum(plane, mine - p["outer"]), np.maximum(p["inner"] - mine, 0.0)) - 1e-7
                need = (np.maximum(bound, 0.0) ** 2 <= (2.0 - 2.0 * least[at] + _SLACK)[:, None])[:, p["of"]]
                known = np.flatnonzero(met[at] >= 0)
                need[known, met[at][known]] = False
                for t in range(p["tile"][-1] + 1):
                    units = np.flatnonzero(p["tile"] == t)
                    mask = need[:, units] @ (np.int64(1) << p["bit"][units].astype(np.int64))
                    some = np.flatnonzero(mask)
                    if len(some):
                        yield sent(b, at[some], np.full(len(some), t), mask[some], need[some][:, units] @ p["rows"][units], met[at][some])

    def sent(b: pa.RecordBatch, at: np.ndarray, tile: np.ndarray, mask: np.ndarray, rows: np.ndarray, met: np.ndarray) -> pa.RecordBatch:
        take = pa.array(at, pa.int64())
        more = [pa.array(tile, pa.int32()), pa.array(mask, pa.int64()), pa.array(rows, pa.int64()), pa.array(met, pa.int32())]
        return pa.RecordBatch.from_arrays([*(b.column(n).take(take) for n in names), *more], [*names, "tile", "mask", "rows", "met"])

    g = queries.schema["g"].dataType.simpleString()
    return queries.select(*names, "met").mapInArrow(run, f"g {g}, dim int, qn long, u binary, least double, tile int, mask long, rows long, met int")


def _attach(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    r = right.select(*[F.col(x).alias(f"_{x}") for x in on], *[x for x in right.columns if x not in on])
    cond = left["g"].eqNullSafe(r["_g"])
    for x in on[1:]:
        cond = cond & (left[x] == r[f"_{x}"])
    return left.join(r, cond).drop(*[f"_{x}" for x in on])


def _run(sent: DataFrame, tiled: DataFrame, k: int, block: int) -> DataFrame:
    """Meet queries with tiles of the corpus; queries of one tile are dealt out in parts of as many rows."""
    keys = ["g", "dim", "tile"]
    asked = sent.groupBy(*keys).agg(F.count("*").alias("n"))
    asked = asked.select(*keys, F.ceil(F.col("n") / _tile_rows(F.col("dim"), F.col("n"), block)).cast("int").alias("parts"))
    qs = _attach(sent.select(*keys, "qn", "u", "least", "mask"), asked, keys).withColumn("part", F.pmod(F.xxhash64("qn"), F.col("parts")).cast("int"))
    cs = _attach(tiled, asked, keys).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return _meet(qs.select(*keys, "part", "qn", "u", "least", "mask"), cs.select(*keys, "part", "u", "ids", "bit"), k)
