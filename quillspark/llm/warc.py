"""WARC archives as a table of record chunks.

A record's payload is never held whole by the archive code: it is written from
and read into rows of (record, chunk number, bytes), each with the SHA-256 of
all bytes so far, so the last chunk of a record carries its digest.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage, staging_path
from .common import filesystem

CHUNK = 1 << 16
_END = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def chunk_rows(df: DataFrame, payload: Column, *keep: str, chunk: int = CHUNK) -> DataFrame:
    """(record, chunk_no, chunks, data, ...): rows of at most ``chunk`` bytes; an empty payload is one empty chunk.

    ``record`` numbers the input rows, equal ones too.
    """
    rows = df.select(F.monotonically_increasing_id().alias("record"), *keep, F.coalesce(payload, F.lit(b"")).alias("_bytes"))
    count = F.greatest(F.ceil(F.octet_length("_bytes") / chunk), F.lit(1)).cast("int")
    rows = rows.withColumn("chunks", count).select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk_no"))
    return rows.select("record", *keep, "chunks", "chunk_no", F.substring("_bytes", F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("data"))


def plan_records(pages: DataFrame, least: int = 100) -> DataFrame:
    """Payload sizes and digests, and which records are written in full.

    (page_id, payload_bytes, payload_digest, record_type, refers_to), one row
    per page id and payload. Of equal payloads of at least ``least`` bytes the
    smallest page_id is a response, all others revisit it; null ids revisit.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest")).distinct()
    rows = stage(rows, "warc-digests")
    first = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    got = rows.join(first.where("n > 1").select("payload_digest", "first"), "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return got.select(
        "page_id", "payload_bytes", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to")
    )


def _header(row: dict) -> bytes:
    kind, n = row["record_type"], row["payload_bytes"]
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x-record:{row['record']}>", f"WARC-Target-URI: {row['url'] or ''}",
        "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}", f"X-Payload-Bytes: {n}", f"X-Page-Id: {'' if row['page_id'] is None else row['page_id']}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {row['refers_to']}"]
    length = len(_HTTP) + (0 if kind == "revisit" else n)
    return "\r\n".join([*(x.replace("\r", " ").replace("\n", " ") for x in lines), f"Content-Length: {length}"]).encode() + _END


def write_warc(pages: DataFrame, folder: str | None = None, *, least: int = 100, chunk: int = CHUNK, file_bytes: int = 256 << 20) -> DataFrame:
    """Write a record per row of (page_id, url, html); returns the list of files.

    Null html is an empty payload, a null url an empty one, a null page_id an
    empty header. Equal rows give a record each. Payloads travel to their task
    in chunks and are compressed as they come, a gzip member per record. A task
    begins a new file after ``file_bytes``. An empty table writes no file.
    """
    spark = pages.sparkSession
    target = folder or staging_path(spark, "warc")
    plan = plan_records(pages, least)
    utf8 = F.encode("html", "UTF-8")
    keyed = pages.select("page_id", "url", utf8.alias("_p")).withColumn("payload_digest", F.sha2(F.coalesce("_p", F.lit(b"")), 256))
    chunks = chunk_rows(keyed, F.col("_p"), "page_id", "url", "payload_digest", chunk=chunk)
    p = plan.select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_d"), "payload_bytes", "record_type", "refers_to")
    joined = chunks.join(p, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("payload_digest") == F.col("_d"))).drop("_id", "_d")
    # a revisit has no payload in the archive: its first chunk stands for the record
    joined = joined.where("record_type = 'response' or chunk_no = 0").withColumn("data", F.when(F.col("record_type") == "response", F.col("data")).otherwise(F.lit(b"")))
    # the join deals rows by page and digest (or not at all), so the chunks of a record are in one task already
    dealt = joined.sortWithinPartitions("record", "chunk_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, where = filesystem(target)
        fs.create_dir(where, recursive=True)
        out, seq, size, records, done, last = None, 0, 0, 0, [], None

        def close() -> None:
            nonlocal out, size, records, seq
            if out is not None:
                out.close()
                name = f"part-{task.partitionId():06d}-{seq:05d}.warc.gz"
                fs.move(f"{where}/_{name}.{task.taskAttemptId()}", f"{where}/{name}")
                done.append({"file": f"{target}/{name}", "bytes": size, "records": records})
            out, size, records, seq = None, 0, 0, seq + 1

        def put(data: bytes) -> None:
            nonlocal size
            out.write(data)
            size += len(data)

        def member(data: bytes, gz, finish: bool) -> None:
            put(gz.compress(data))
            if finish:
                put(gz.compress(_END))
                put(gz.flush())

        gz = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["record"] != last:
                    if out is None or size >= file_bytes:
                        close()
                        out = fs.open_output_stream(f"{where}/_part-{task.partitionId():06d}-{seq:05d}.warc.gz.{task.taskAttemptId()}", compression=None)
                    gz, last, records = zlib.compressobj(1, zlib.DEFLATED, 31), row["record"], records + 1
                    member(_header(row) + _HTTP, gz, False)
                member(row["data"], gz, row["record_type"] != "response" or row["chunk_no"] == row["chunks"] - 1)
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done)

    return stage(dealt.mapInArrow(run, "file string, bytes long, records long"), "warc-files")


class _Stream:
    """Unpacks gzip members one after another, a bounded piece at a time."""

    def __init__(self, source) -> None:
        self.source, self.gz, self.packed, self.plain = source, None, b"", bytearray()

    def _more(self) -> bool:
        """Unpack some more; False at the end of the file."""
        if not self.packed:
            self.packed = self.source.read(CHUNK)
            if not self.packed:
                return False
        if self.gz is None:
            self.gz = zlib.decompressobj(31)
        self.plain += self.gz.decompress(self.packed, CHUNK)
        self.packed = self.gz.unconsumed_tail
        if self.gz.eof:
            self.packed, self.gz = self.gz.unused_data, None
        return True

    def until(self, mark: bytes) -> bytes | None:
        """All up to a mark, without it; None at the end of the file."""
        seen = 0
        while (at := self.plain.find(mark, seen)) < 0:
            seen = max(0, len(self.plain) - len(mark))
            if not self._more():
                return None
        got = bytes(self.plain[:at])
        del self.plain[: at + len(mark)]
        return got

    def take(self, most: int) -> bytes:
        while len(self.plain) < most:
            if not self._more():
                break
        got = bytes(self.plain[:most])
        del self.plain[:most]
        return got


def read_warc(files: DataFrame, *, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk table of the listed files.

    (file, record, page_id, url, record_type, refers_to, payload_bytes,
    stated_digest, chunk_no, chunk_bytes, digest, data): ``digest`` is the
    SHA-256 of the payload up to the end of this chunk. A record without a
    payload of its own has one empty chunk. A file that ends inside a record
    raises an error.
    """
    cores = files.sparkSession.sparkContext.defaultParallelism
    schema = pa.schema([
        ("file", pa.string()), ("record", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()), ("stated_digest", pa.string()), ("chunk_no", pa.int64()), ("chunk_bytes", pa.int64()), ("digest", pa.string()), ("data", pa.binary()),
    ])

    def rows(name: str) -> Iterator[dict]:
        fs, path = filesystem(name)
        with fs.open_input_stream(path, compression=None) as source:
            s = _Stream(source)
            while (head := s.until(_END)) is not None:
                if not head.strip():
                    continue
                fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").strip().split("\r\n")[1:] if ": " in x)
                number = lambda key: int(fields[key]) if fields.get(key) else None
                http = s.until(_END)
                left = int(fields["Content-Length"]) - len(http) - len(_END)
                base = {
                    "file": name, "record": fields["WARC-Record-ID"], "page_id": number("X-Page-Id"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
                    "refers_to": number("X-Refers-To-Page"), "payload_bytes": number("X-Payload-Bytes"), "stated_digest": fields.get("WARC-Payload-Digest", "").removeprefix("sha256:"),
                }
                digest, k = hashlib.sha256(), 0
                while left or not k:
                    data = s.take(min(chunk, left))
                    if len(data) < min(chunk, left):
                        raise EOFError(f"{name} ends inside a record")
                    digest.update(data)
                    left -= len(data)
                    yield {**base, "chunk_no": k, "chunk_bytes": len(data), "digest": digest.hexdigest(), "data": data if with_data else None}
                    k += 1
                s.until(_END)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for name in batch.column("file").to_pylist():
                for row in rows(name):
                    held.append(row)
                    size += row["chunk_bytes"]
                    if size >= 8 << 20 or len(held) >= 2000:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    kinds = "file string, record string, page_id long, url string, record_type string, refers_to long, payload_bytes long, stated_digest string, chunk_no long, chunk_bytes long, digest string, data binary"
    return files.select("file").repartition(max(cores, files.count()), "file").mapInArrow(run, kinds)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: sizes and digests of the payload read, or those stated where a revisit has none."""
    got = chunks.groupBy("file", "record").agg(
        F.first("page_id").alias("page_id"), F.first("record_type").alias("record_type"), F.first("refers_to").alias("refers_to"),
        F.first("payload_bytes").alias("stated"), F.first("stated_digest").alias("stated_digest"),
        F.sum("chunk_bytes").alias("read"), F.max_by("digest", "chunk_no").alias("digest"),
    )
    own = F.col("record_type") != "revisit"
    return got.select(
        "page_id", F.when(own, F.col("read")).otherwise(F.col("stated")).alias("payload_bytes"), F.when(own, F.col("digest")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type", "refers_to",
    )
