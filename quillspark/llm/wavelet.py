"""Token files as wavelet matrices: bit-planes with rank and select.

A file holds the concatenated token ids of a run of documents as one bit-plane
per binary digit, the highest first; each plane is stably partitioned by the
plane before it. Planes are cut into blocks that are compressed alone, with the
number of ones before each block beside them, so that a token, a count or the
place of an occurrence is found by reading one block per plane.

Layout: ``QWM1``, length of the header (8 bytes), header (JSON), directory
(ones before each block, place and size of each block, document table), blocks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage, staging_path
from .common import write_file
from .encode import encode_table

MAGIC = b"QWM1"
BLOCK = 1 << 16  # bits of a block


def build(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> list[bytes]:
    """The parts of a file for the ids of some documents, one after another."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    zstd = zstandard.ZstdCompressor(level=1)
    rest = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    zeros, ones, spans, blocks, at = [], [], [], [], 0
    for plane in range(bits - 1, -1, -1):
        low, high, before = [], [], 0
        for start in range(0, len(rest), BLOCK):  # a block and its places stay in the cache
            part = rest[start : start + BLOCK]
            bit = part & part.dtype.type(1 << plane) != 0
            raw = np.packbits(bit, bitorder="little").tobytes()
            small = zstd.compress(raw)
            kept = small if len(small) < len(raw) else raw
            ones.append(before)
            spans.append((at, len(kept), len(kept) == len(raw)))
            at += len(kept)
            blocks.append(kept)
            high.append(part.take(np.flatnonzero(bit)))
            low.append(part.take(np.flatnonzero(~bit)))
            before += len(high[-1])
        zeros.append(len(rest) - before)
        rest = np.concatenate(low + high) if low else rest
    table = [
        np.array(ones, "<i8").tobytes(), np.array(spans, "<i8").tobytes(),
        np.array([x is None for x in doc_ids], "u1").tobytes(), np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array(lengths, "<i8").tobytes(),
    ]
    packed = [zstd.compress(x) for x in table]
    header = json.dumps({"tokens": len(ids), "bits": bits, "zeros": zeros, "docs": len(doc_ids), "tables": [len(x) for x in packed]}).encode()
    return [MAGIC + len(header).to_bytes(8, "little") + header, *packed, *blocks]


class WaveletFile:
    """Reads one file, given as its bytes; blocks are unpacked when they are needed."""

    def __init__(self, content: bytes) -> None:
        view = memoryview(content)
        if bytes(view[:4]) != MAGIC:
            raise ValueError("not a token file")
        n = int.from_bytes(view[4:12], "little")
        head = json.loads(bytes(view[12 : 12 + n]))
        self.tokens, self.bits, self.zeros = head["tokens"], head["bits"], head["zeros"]
        self._zstd, at, tables = zstandard.ZstdDecompressor(), 12 + n, []
        for size in head["tables"]:
            tables.append(self._zstd.decompress(bytes(view[at : at + size])))
            at += size
        self._blocks = view[at:]
        self._per = -(-self.tokens // BLOCK)
        self._ones = np.frombuffer(tables[0], "<i8").reshape(self.bits, self._per)
        self._spans = np.frombuffer(tables[1], "<i8").reshape(self.bits, self._per, 3)
        missing, ids = np.frombuffer(tables[2], "u1"), np.frombuffer(tables[3], "<i8")
        self.doc_ids = [None if m else int(i) for m, i in zip(missing, ids)]
        self.lengths = np.frombuffer(tables[4], "<i8")
        self._kept: dict[tuple[int, int], np.ndarray] = {}

    def _block(self, plane: int, k: int) -> np.ndarray:
        if (plane, k) not in self._kept:
            if len(self._kept) > 64:
                self._kept.clear()
            at, size, raw = self._spans[plane, k]
            data = bytes(self._blocks[at : at + size])
            bits = np.unpackbits(np.frombuffer(data if raw else self._zstd.decompress(data), "u1"), bitorder="little")
            self._kept[plane, k] = bits[: min(BLOCK, self.tokens - k * BLOCK)]
        return self._kept[plane, k]

    def _rank1(self, plane: int, at: int) -> int:
        """Ones before a place of a plane."""
        if at >= self.tokens:
            return self.tokens - self.zeros[plane]
        k, rest = divmod(at, BLOCK)
        return int(self._ones[plane, k]) + int(self._block(plane, k)[:rest].sum())

    def _select(self, plane: int, one: int, k: int) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        before = self._ones[plane] if one else np.arange(self._per) * BLOCK - self._ones[plane]
        block = int(np.searchsorted(before, k, "right")) - 1
        found = np.flatnonzero(self._block(plane, block) == one)
        return block * BLOCK + int(found[k - int(before[block])])

    def access(self, at: int) -> int:
        """The token at a place."""
        if not 0 <= at < self.tokens:
            raise IndexError(at)
        value = 0
        for plane in range(self.bits):
            ones = self._rank1(plane, at)
            bit = int(self._block(plane, at // BLOCK)[at % BLOCK])
            at = self.zeros[plane] + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for plane in range(self.bits):
            a, b = self._rank1(plane, lo), self._rank1(plane, hi)
            lo, hi = (self.zeros[plane] + a, self.zeros[plane] + b) if token >> (self.bits - 1 - plane) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often a token stands between two places."""
        if token < 0 or token >> self.bits:
            return 0
        lo, hi = self._range(token, lo, self.tokens if hi is None else hi)
        return max(0, hi - lo)

    def rank(self, token: int, at: int) -> int:
        """How often a token stands before a place."""
        return self.count(token, 0, at)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of a token."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        at = self._range(token, 0, self.tokens)[0] + k
        for plane in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - plane) & 1
            at = self._select(plane, one, at - self.zeros[plane] if one else at)
        return at

    def locate(self, token: int) -> Iterator[int]:
        """All places of a token, in order."""
        return (self.select(token, k) for k in range(self.count(token)))

    def decode(self) -> np.ndarray:
        """All tokens, from the lowest plane up."""
        values = np.zeros(self.tokens, "<u2" if self.bits <= 16 else "<u4")
        for plane in range(self.bits - 1, -1, -1):
            zeros, one = self.zeros[plane], values.dtype.type(1 << (self.bits - 1 - plane))
            values[zeros:] |= one
            above = np.empty_like(values)
            for k in range(self._per):
                bit, before = self._block(plane, k).view(bool), int(self._ones[plane, k])
                part = above[k * BLOCK : k * BLOCK + len(bit)]
                high, low = np.flatnonzero(bit), np.flatnonzero(~bit)
                part[high] = values[zeros + before : zeros + before + len(high)]
                part[low] = values[k * BLOCK - before : k * BLOCK - before + len(low)]
            values = above
        return values.astype("<u4")


# --- writing and reading on Spark ----------------------------------------------------


def write_token_files(
    df: DataFrame, path: str, end_id: int, *, id_col: str = "doc_id", text: str = "text",
    range_bytes: int = 16 << 20, file_tokens: int = 4 << 20, folder: str | None = None,
) -> DataFrame:
    """Encode texts and write them in ascending id order; returns the list of files.

    Ids with null come first; equal ids follow each other by text. A null text
    is an empty one, and each document ends with ``end_id``. An empty table
    writes no file. One range of ids is about ``range_bytes`` of text, and a
    task begins a new file after ``file_tokens`` tokens, so neither a task's
    memory nor a file grows with the table. Result: (part, seq, file, tokens,
    docs, start), ``start`` being the tokens of all files before.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    target = folder or staging_path(spark, "token-files")
    dealt = docs.repartitionByRange(max(1, -(-size // range_bytes)), "doc_id").sortWithinPartitions("doc_id", "text")
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, seq, ids, names, lengths, total = task.partitionId(), 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{seq:05d}.qwm"
            write_file(target, name, task.taskAttemptId(), build(np.frombuffer(b"".join(ids), "<u4"), names, lengths))
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "file": name, "tokens": total, "docs": len(names)}], schema=shape)

        shape = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("file", pa.string()), ("tokens", pa.int64()), ("docs", pa.int64())])
        for batch, found in encode_table(batches, path, "text"):
            for name, got in zip(batch.column("doc_id").to_pylist(), found):
                ids.append(got + end)
                names.append(name)
                lengths.append(len(got) // 4 + 1)
                total += lengths[-1]
                if total >= file_tokens:
                    yield flush()
                    seq, ids, names, lengths, total = seq + 1, [], [], [], 0
        if names:
            yield flush()

    made = stage(dealt.mapInArrow(run, "part long, seq long, file string, tokens long, docs long"), "token-file-list")
    # offsets in two steps: one row per task, then the files of a task
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = made.groupBy("part").agg(F.sum("tokens").alias("all")).select("part", F.coalesce(F.sum("all").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    out = made.withColumn("before", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(parts, "part")
    return out.select("part", "seq", F.concat(F.lit(f"{target}/"), "file").alias("file"), "tokens", "docs", (F.col("base") + F.col("before")).alias("start"))


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document of the listed files.

    ``ids`` are little-endian unsigned 32-bit integers, ``start`` the number of
    ids before the document over all files. Each file is read by one task.
    """
    spark = files.sparkSession
    folders = [r[0] for r in files.select(F.regexp_extract("file", "^(.*)/[^/]*$", 1)).distinct().collect()]
    schema = "name string, doc_id long, local long, ids binary"
    if not folders:
        return spark.createDataFrame([], "doc_id long, start long, ids binary")
    content = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.qwm").load(folders).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                got = WaveletFile(data.as_buffer())
                ids, stops = got.decode(), np.cumsum(got.lengths)
                starts = stops - got.lengths
                for at in range(0, len(starts), 2048):
                    a, b = starts[at : at + 2048], stops[at : at + 2048]
                    cut = [ids[x:y].tobytes() for x, y in zip(a, b)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path.rsplit("/", 1)[1]] * len(a)), pa.array(got.doc_ids[at : at + 2048], pa.int64()), pa.array(a, pa.int64()), pa.array(cut, pa.binary())],
                        ["name", "doc_id", "local", "ids"],
                    )

    read = content.mapInArrow(run, schema)
    base = files.select(F.regexp_extract("file", "([^/]*)$", 1).alias("name"), F.col("start").alias("base"))
    return read.join(F.broadcast(base) if files.count() <= 100_000 else base, "name").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "ids")


