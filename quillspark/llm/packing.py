"""Sum-of-squares packing of documents into sequences of a fixed length.

A document goes to the open bin after which the sum over all residual gaps of
the squared number of open bins with that gap is smallest. Only the number of
open bins per gap matters, so the state of a task is one row of counters and
the numbers of its open bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import stage
from .encode import encode_ids


class SumOfSquares:
    """Places items one by one into bins of ``capacity``."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bins = 0

    def _put(self, size: int, gap: int) -> tuple[int, int]:
        """Into an open bin with this gap; a gap of the whole capacity opens a bin."""
        if gap < self.capacity:
            at = self.open[gap].pop()
            self.count[gap] -= 1
        else:
            at, self.bins = self.bins, self.bins + 1
        if size < gap:
            self.open[gap - size].append(at)
            self.count[gap - size] += 1
        return at, self.capacity - gap

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) for an item by the sum-of-squares rule; ties take the smallest gap."""
        c, n = self.capacity, self.count
        gaps = np.flatnonzero(n[size:c]) + size
        best, gap = 2 * n[c - size] + 1 if size < c else 0, c
        if len(gaps):
            left = gaps - size  # a gap loses a bin and the gap left gets one; a full bin counts nothing
            change = 1 - 2 * n[gaps] + np.where(left > 0, 2 * n[left] + 1, 0)
            k = int(np.argmin(change))
            if change[k] <= best:
                gap = int(gaps[k])
        return self._put(size, gap)

    def close(self, size: int) -> tuple[int, int]:
        """(bin, offset) for one of the last items: the smallest gap that holds it."""
        gaps = np.flatnonzero(self.count[size : self.capacity])
        return self._put(size, int(gaps[0]) + size if len(gaps) else self.capacity)


def cut_pieces(encoded: DataFrame, capacity: int, ids: str = "ids") -> DataFrame:
    """One row per piece: the other columns, ``piece``, ``start``, ``length`` and ``piece_ids``.

    Only documents longer than ``capacity`` are cut; their first piece may be
    shorter, all others are full. Clashing columns of the input are replaced.
    """
    others = [c for c in encoded.columns if c not in (ids, "piece", "start", "length", "piece_ids")]
    n = (F.octet_length(ids) / 4).cast("long")
    rest = F.when(n % capacity == 0, F.lit(capacity)).otherwise(n % capacity)
    count = F.ceil(n / capacity).cast("int")
    got = encoded.withColumn("_rest", F.when(n > 0, rest).otherwise(0)).select(*others, ids, "_rest", F.explode(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))).alias("piece"))
    start = F.when(F.col("piece") == 0, 0).otherwise(F.col("_rest") + (F.col("piece") - 1) * capacity).cast("long")
    length = F.when(F.col("piece") == 0, F.col("_rest")).otherwise(capacity).cast("long")
    got = got.select(*others, "piece", start.alias("start"), length.alias("length"), ids)
    return got.select(*others, "piece", "start", "length", F.substring(F.col(ids), (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")).alias("piece_ids"))


def pack(pieces: DataFrame, capacity: int, rows_per_task: int = 40_000, length: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a length of at most ``capacity``.

    Rows are dealt out evenly, whatever their keys; each task packs its own in
    bounded runs: the longer four fifths, largest first, by the sum-of-squares
    rule, which keeps gaps of all sizes open, then the shortest fifth into the
    smallest gaps that hold them. (Under the rule alone about 0.5% more bins
    stay open.) The bins open at the end of a task are the price of packing in
    parallel, a few of many thousand. Lengths are from 1 to ``capacity``.
    """
    cols = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    tasks = max(1, -(-pieces.count() // rows_per_task))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, packer, held, rows = TaskContext.get().partitionId(), SumOfSquares(capacity), [], 0

        def place() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            sizes = table.column(length).to_numpy()
            at, off = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            order = np.argsort(-sizes, kind="stable")
            last = len(order) - len(order) // 5
            for k in order[:last]:
                at[k], off[k] = packer.place(int(sizes[k]))
            for k in order[last:]:
                at[k], off[k] = packer.close(int(sizes[k]))
            table = table.append_column("sequence_id", pa.array((part << 40) + at)).append_column("offset", pa.array(off))
            return table.combine_chunks()

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= rows_per_task:
                yield from place().to_batches(max_chunksize=10_000)
                held, rows = [], 0
        if held:
            yield from place().to_batches(max_chunksize=10_000)

    schema = StructType([*(pieces.schema[c] for c in cols), StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return pieces.select(*cols).repartition(tasks).mapInArrow(run, schema)


def pack_documents(df: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(placements, pieces): every document encoded, cut and packed.

    ``pieces`` has the ids of every piece, ``placements`` one row per piece
    without ids but with the crc32 of its ids, and its place. Only the narrow
    rows are dealt out; ids are joined where sequences are written
    (``write_sequences``). A null or empty text is its end id; repeated rows
    are packed each; an empty table gives no row.
    """
    pieces = cut_pieces(encode_ids(df, path, end_id, text=text), capacity)
    keep = [c for c in pieces.columns if c != "piece_ids"]
    narrow = stage(pieces.select(*keep, F.crc32("piece_ids").alias("ids_crc32")), "pieces")
    return pack(narrow, capacity), pieces


def write_sequences(placements: DataFrame, pieces: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Write (sequence_id, ids) as Parquet: each sequence's pieces in order of offset.

    ``key`` must name a document; a sequence has at most ``capacity`` ids.
    """
    on = F.expr(f"p.{key} <=> q.{key} and p.piece = q.piece")
    got = placements.alias("p").join(pieces.alias("q"), on).select("p.sequence_id", "p.offset", "q.piece_ids")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "piece_ids"))), lambda x: x["piece_ids"])
    got.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids")).write.mode("overwrite").parquet(folder)
    return placements.sparkSession.read.parquet(folder)
