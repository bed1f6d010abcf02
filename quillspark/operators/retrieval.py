"""Exact cosine top-k over vectors.

A query set that is proven small is broadcast: the corpus is read once without
a shuffle, and only the k best per query and task are emitted. A larger one is
joined by pivot cells (``knn``), which compares only what can be a neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .knn import ROWS_PER_CELL, knn_join, usable
from .ranking import top_n

MAX_BROADCAST_QUERIES = 4096
MAX_BROADCAST_BYTES = 64 << 20
_QUERY_STEP = 512  # queries per matrix product
_DIGITS = 9  # similarities that agree to here are ties, broken by id
_HITS = pa.schema([("query_id", pa.int64()), ("neighbor_id", pa.int64()), ("similarity", pa.float64())])
_HITS_DDL = "query_id bigint, neighbor_id bigint, similarity double"


def _unit_rows(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    lengths = np.unique(arr.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False))
    if len(lengths) > 1 or (len(lengths) and lengths[0] < 1):
        raise ValueError(f"vectors must be non-null and of one length, found lengths {lengths[:5].tolist()} (-1 is NULL)")
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    m = flat.reshape(len(arr), -1) if len(arr) else flat.reshape(0, 1)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _best(sims: np.ndarray, q_ids: np.ndarray, c_ids: np.ndarray, k: int, exclude_self: bool) -> tuple[np.ndarray, ...]:
    """Flat (query, neighbour, similarity) of the k best per row, ties by id."""
    s = np.round(sims, _DIGITS)
    if exclude_self:
        s[q_ids[:, None] == c_ids[None, :]] = -np.inf
    if s.shape[1] > k:
        edge = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k][:, None]
    else:
        edge = np.full((s.shape[0], 1), -np.inf)
    rows, cols = np.nonzero((s >= edge) & (s > -np.inf))
    order = np.lexsort((c_ids[cols], -s[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    first = np.searchsorted(rows, rows, side="left")
    keep = np.arange(len(rows)) - first < k
    rows, cols = rows[keep], cols[keep]
    return q_ids[rows], c_ids[cols], s[rows, cols]


def _block_hits(q_ids, q, c_ids, c, k, exclude_self) -> pa.RecordBatch:
    parts = [
        _best(q[i : i + _QUERY_STEP] @ c.T, q_ids[i : i + _QUERY_STEP], c_ids, k, exclude_self)
        for i in range(0, len(q_ids), _QUERY_STEP)
    ]
    cols = [np.concatenate([p[j] for p in parts]) if parts else np.array([]) for j in range(3)]
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], schema=_HITS
    )


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    out = top_n(hits, ["query_id"], [F.desc("similarity"), F.asc("neighbor_id")], k)
    return out.select("query_id", "rank", "neighbor_id", "similarity")


def topk(
    queries: DataFrame, corpus: DataFrame, k: int, *, id_col: str = "vec_id", vector: str = "embedding",
    exclude_self: bool = True, max_broadcast: int = MAX_BROADCAST_QUERIES, rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """(query_id, rank, neighbor_id, similarity), the k nearest rows by cosine.

    The number and size of the queries are checked first; they decide between
    the two plans, which give the same rows. Rows without a usable vector (null,
    empty, null or non-finite components) take no part; vectors meet only
    vectors of their own length.
    """
    q = queries.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).alias("v")).where(usable("v"))
    c = corpus.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).alias("v")).where(usable("v"))
    few = q.limit(max_broadcast + 1).toArrow()
    lengths = few.column("v").combine_chunks().value_lengths().unique()
    if few.num_rows > max_broadcast or few.nbytes > MAX_BROADCAST_BYTES or len(lengths) > 1:
        one = lambda side: side.select(F.lit(0).alias("g"), "id", "v")
        return knn_join(one(q), one(c), k, exclude_self=exclude_self, rows_per_cell=rows_per_cell)
    c = c.where(F.size("v") == (lengths[0].as_py() if len(lengths) else 0))
    held = q.sparkSession.sparkContext.broadcast((few.column("id").to_numpy(), _unit_rows(few.column("v"))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, qm = held.value
        best: pa.Table | None = None
        for b in batches:
            if not b.num_rows or not len(q_ids):
                continue
            hits = _block_hits(q_ids, qm, b.column(0).to_numpy(), _unit_rows(b.column(1)), k, exclude_self)
            if best is None:
                best = hits
            else:  # keep k per query over the whole partition
                both = pa.Table.from_batches([best, hits])
                qi, ci, s = (both.column(i).to_numpy() for i in range(3))
                order = np.lexsort((ci, -s, qi))
                qi, ci, s = qi[order], ci[order], s[order]
                keep = np.arange(len(qi)) - np.searchsorted(qi, qi, side="left") < k
                best = pa.RecordBatch.from_arrays([pa.array(qi[keep]), pa.array(ci[keep]), pa.array(s[keep])], schema=_HITS)
        if best is not None:
            yield best

    return _ranked(c.mapInArrow(scan, _HITS_DDL), k)


def topk_within(df: DataFrame, *, group: str, id_col: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """The k nearest rows of the same group, for every row."""
    side = df.select(F.col(group).alias("g"), F.col(id_col).cast("bigint").alias("id"), F.col(vector).alias("v"))
    return knn_join(side, side, k)


def with_attributes(hits: DataFrame, rows: DataFrame, columns: Sequence[str], *, id_col: str = "vec_id", side: str = "neighbor") -> DataFrame:
    """Attach columns of the query or neighbour row, prefixed by the side."""
    attrs = rows.select(F.col(id_col).alias(f"{side}_id"), *[F.col(c).alias(f"{side}_{c}") for c in columns])
    return hits.join(attrs, f"{side}_id")


def knn_vote(hits: DataFrame, rows: DataFrame, *, id_col: str = "vec_id", label: str = "label") -> DataFrame:
    """(query_id, pred, votes): the commonest neighbour label, ties to the lower."""
    v = with_attributes(hits, rows, [label], id_col=id_col)
    c = v.groupBy("query_id", F.col(f"neighbor_{label}").alias("pred")).agg(F.count("*").alias("votes"))
    return top_n(c, ["query_id"], [F.desc("votes"), F.asc("pred")], 1).drop("rank")


def satisfaction(hits: DataFrame, *, true_label: str = "query_label", neighbor_label: str = "neighbor_label", min_similarity: float = 0.7) -> DataFrame:
    """Per query: neighbours with the true label, mean similarity, satisfied."""
    s = hits.groupBy("query_id").agg(
        F.count_if(F.col(true_label) == F.col(neighbor_label)).alias("same_label"), F.avg("similarity").alias("mean_similarity")
    )
    return s.withColumn("satisfied", (F.col("same_label") >= 1) | (F.col("mean_similarity") >= min_similarity))


def satisfaction_rate(per_query: DataFrame) -> DataFrame:
    return per_query.agg(F.count("*").alias("n_queries"), F.avg(F.col("satisfied").cast("double")).alias("rate"))


def fuse_ranks(a: DataFrame, b: DataFrame, k: int, *, c: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of two result lists."""
    both = a.select("query_id", "neighbor_id", "rank").unionByName(b.select("query_id", "neighbor_id", "rank"))
    s = both.groupBy("query_id", "neighbor_id").agg(F.sum(F.lit(1.0) / (F.lit(c) + F.col("rank"))).alias("score"))
    return top_n(s, ["query_id"], [F.desc(F.round("score", 9)), F.asc("neighbor_id")], k).select("query_id", "rank", "neighbor_id", "score")
