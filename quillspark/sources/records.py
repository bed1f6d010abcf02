"""Quoted records of large CSV files, read by many tasks.

A record may span lines, so a task that starts in the middle of a file cannot
tell by itself whether it stands inside a quoted value. The first pass notes
for each split how it ends if it starts outside, and how if it starts inside.
Composing these along a file gives the true start of every split. The second
pass joins lines to records; only records that cross a split are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import stage

_JAVA_NAMES = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "latin1": "ISO-8859-1", "gb18030": "GB18030", "gbk": "GBK", "gb2312": "GB2312"}
_REPLACEMENT = "�"
_BOM = b"\xef\xbb\xbf"
_SPLIT = ["fid", "at", "size"]
#: Splits up to this number (about 50 bytes each) are broadcast to the second pass.
BROADCAST_SPLITS = 500_000


def java_name(charset: str) -> str:
    return _JAVA_NAMES.get(charset.lower(), charset)


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Session settings that hold only while plans are made inside."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def decoded(raw: Column, charset: str) -> Column:
    """Text of bytes; those that do not fit the charset become U+FFFD if the
    query runs under ``lenient``."""
    return F.decode(raw, java_name(charset))


def lenient(spark: SparkSession):
    """Settings a query that decodes must run under, up to its written result."""
    return settings(spark, **{"spark.sql.legacy.javaCharsets": "true", "spark.sql.legacy.codingErrorAction": "true"})


def lines_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, at, size, value): lines as raw bytes, with the split they begin in.

    A line ends at a line feed, whose byte is part of no character in any
    charset of the ladders. Lines of one split come together and in order.
    """
    m = F.col("_metadata")
    return spark.read.text(path, lineSep="\n").select(
        m["file_path"].alias("file"), m["file_block_start"].alias("at"), m["file_block_length"].alias("size"), F.col("value").cast("binary").alias("value")
    )


def misfits(charsets: Sequence[str]) -> list[Column]:
    """For each charset, whether the bytes ``value`` of a line do not fit it. To
    be used under ``lenient``."""
    return [
        ~F.is_valid_utf8(F.col("value").cast("string")) if java_name(c) == "UTF-8" else F.contains(decoded(F.col("value"), c), F.lit(_REPLACEMENT))
        for c in charsets
    ]


def beyond_ascii() -> Column:
    return F.col("value").cast("string").rlike(r"[^\x00-\x7f]")


def best_charset(shares: Column, tolerance: float) -> Column:
    """Position of the first share within the tolerance of the least one."""
    return F.array_position(F.transform(shares, lambda x: x <= F.array_min(shares) + tolerance), F.lit(True)).cast("int") - 1


# --- where quoted values begin and end -----------------------------------------------


def _stepper(sep: str) -> Callable[[int, bytes], int]:
    """step(state, line): 1 if a quoted value is open behind the line, else 0.

    State 1 means that one is open before it. A quote opens a value only as its
    first character and two quotes inside stand for one; what follows the
    closing quote is plain up to the separator.
    """
    s = re.escape(sep.encode())
    plain = rb"[^" + s + rb"]*+" if len(sep) == 1 else rb"(?:(?!" + s + rb").)*+"
    close = rb'(?:[^"]++|"")*+"' + plain
    field = rb'(?:"' + close + rb'|(?!")' + plain + rb")"
    more = rb"(?:" + s + field + rb")*+"
    patterns = (re.compile(field + more, re.S), re.compile(close + more, re.S))
    return lambda state, line: 0 if patterns[state].fullmatch(line) else 1


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, bool, pd.DataFrame]]:
    """(split, whether it begins here, its rows in this batch), in order."""
    now = None
    for b in batches:
        if not len(b):
            continue
        keys = b[_SPLIT].to_numpy()
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(b)]
        for i, j in zip(cuts[:-1], cuts[1:]):
            key = tuple(int(x) for x in keys[i])
            yield key, key != now, b.iloc[i:j]
            now = key


def _survey(sep: str, n: int):
    """Per split: its ends for both starts, whether a value open at its start
    closes in it, and the counts of lines by charset."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = _stepper(sep)
        split, ends, closes, counts = None, (0, 1), False, np.zeros(n + 2, "int64")

        def row() -> pd.DataFrame:
            return pd.DataFrame([[*split, *ends, closes, counts.tolist()]], columns=[*_SPLIT, "end0", "end1", "closes", "counts"])

        for key, begins, b in _runs(batches):
            if begins:
                if split is not None:
                    yield row()
                split, ends, closes, counts = key, (0, 1), False, np.zeros(n + 2, "int64")
            counts += np.array([len(b), b["other"].sum(), *np.array(b["bad"].tolist(), "int64").reshape(len(b), n).sum(axis=0)], "int64")
            quoted = b["value"].to_numpy()
            for i in np.flatnonzero(b["value"].notna()):
                line = bytes(quoted[i])
                if begins and i == 0 and key[1] == 0:
                    line = line.removeprefix(_BOM)
                first = step(ends[0], line)
                ends = (first, first if ends[0] == ends[1] else step(ends[1], line))
                closes = closes or ends[1] == 0
        if split is not None:
            yield row()

    return run


def survey(spark: SparkSession, path: str | list[str], charsets: Sequence[str], sep: str = ",") -> DataFrame:
    """(fid, at, size, end0, end1, closes, counts): one scan of all lines."""
    quoted = F.contains(F.col("value"), F.lit(b'"'))
    rows = lines_of(spark, path).select(
        F.xxhash64("file").alias("fid"), "at", "size", F.coalesce(beyond_ascii(), F.lit(False)).alias("other"),
        F.array(*[F.coalesce(x.cast("int"), F.lit(1)) for x in misfits(charsets)]).alias("bad"), F.when(quoted, F.col("value")).alias("value"),
    )
    return rows.mapInPandas(_survey(sep, len(charsets)), "fid bigint, at bigint, size bigint, end0 int, end1 int, closes boolean, counts array<bigint>")


def starts(found: DataFrame, tolerance: float) -> DataFrame:
    """(fid, at, size, state, owner, charset): the true start of every split.

    A split maps the state before it to the state behind it. Those with equal
    ends fix the state, those that swap it are counted since the last of these.
    ``owner`` is the split in which the record open at the start begins;
    ``charset`` the position of the file's charset.
    """
    file = Window.partitionBy("fid").orderBy("at")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.col("end0") > F.col("end1")
    f = found.withColumn("swaps", F.sum(swaps.cast("long")).over(file))
    fixed = F.last(F.when(F.col("end0") == F.col("end1"), F.struct("end0", "swaps")), ignorenulls=True).over(before)
    f = f.withColumn("fixed", fixed).withColumn("swapped", F.coalesce(F.sum(swaps.cast("long")).over(before), F.lit(0)))
    zero = F.lit(0)
    state = (F.coalesce(F.col("fixed.end0"), zero) + F.col("swapped") - F.coalesce(F.col("fixed.swaps"), zero)) % 2
    f = f.withColumn("state", state.cast("int"))
    opens = F.when(F.col("state") == 0, F.col("end0") == 1).otherwise((F.col("end1") == 1) & F.col("closes"))
    owner = F.last(F.when(opens, F.col("at")), ignorenulls=True).over(before)
    every = Window.partitionBy("fid")
    n = F.size("counts")
    total = lambda i: F.sum(F.get("counts", i)).over(every)
    f = f.withColumn("owner", F.when(F.col("state") == 1, owner))
    width = found.select(F.max(n)).first()[0] or 2
    shares = F.array(*[total(F.lit(i)) / F.greatest(total(F.lit(1)), F.lit(1)) for i in range(2, width)])
    return f.withColumn("shares", shares).select(*_SPLIT, "state", "owner", best_charset(F.col("shares"), tolerance).alias("charset"))


def _join(sep: str):
    """Lines to records: whole ones without an owner, parts of those that cross
    the split with the owner by which they are put together."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = _stepper(sep)
        columns = ["fid", "charset", "at", "first", "owner", "raw"]
        split, state, owner, charset, held, fresh = None, 0, None, None, [], False

        def frame(rows: list) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=columns).astype({"owner": "Int64"})

        def emit(record: bytes, own) -> list:
            nonlocal fresh
            first, fresh = fresh, False
            return [split[0], charset, split[1], first, own, record]

        for key, begins, b in _runs(batches):
            out = []
            if begins:
                if held:
                    out.append(emit(b"\n".join(held), split[1] if owner is None else owner))
                if b["state"].isna().iloc[0]:
                    raise RuntimeError("a file changed while it was read")
                split, state, charset, held, fresh = key, int(b["state"].iloc[0]), int(b["charset"].iloc[0]), [], key[1] == 0
                owner = int(b["owner"].iloc[0]) if state else None
            lines = [bytes(x) for x in b["value"]]
            if fresh and begins:
                lines[0] = lines[0].removeprefix(_BOM)
            for line in lines:
                nxt = step(state, line) if b'"' in line else state
                if nxt or state:
                    held.append(line)
                if not nxt:
                    # ``owner`` ends with the record that was open at the start
                    out.append(emit(b"\n".join(held), owner) if state else emit(line, None))
                    if state:
                        held, owner = [], None
                state = nxt
            if out:
                yield frame(out)
        if held:
            yield frame([emit(b"\n".join(held), split[1] if owner is None else owner)])

    return run


def read_records(
    spark: SparkSession, path: str | list[str], charsets: Sequence[str], *, sep: str = ",", tolerance: float = 0.05, broadcast_splits: int = BROADCAST_SPLITS
) -> DataFrame:
    """(charset, first, record): the records of CSV files as text, each file in
    its own charset; ``first`` marks the first record of a file.

    Two scans by all tasks, and a staged table of the records, so that the
    result does not depend on how a later job cuts the files. Splits are the
    same in both scans: the settings they depend on are held in between. Empty
    lines between records are left out; a file without lines gives no row. A
    quoted value that is never closed reaches to the end of its file, which
    must then fit into one row. Lines end with a line feed, with or without a
    carriage return before it.
    """
    cores = spark.conf.get("spark.sql.files.minPartitionNum", None) or str(spark.sparkContext.defaultParallelism)
    text = F.coalesce(*[F.when(F.col("charset") == i, decoded(F.col("raw"), c)) for i, c in enumerate(charsets)])
    with settings(spark, **{"spark.sql.files.minPartitionNum": cores}), lenient(spark):
        found = stage(survey(spark, path, charsets, sep), "csv-splits")
        known = stage(starts(found, tolerance), "csv-starts")
        lines = lines_of(spark, path).select(F.xxhash64("file").alias("fid"), "at", "size", "value")
        if known.count() <= broadcast_splits:
            lines = lines.join(F.broadcast(known), _SPLIT, "left")
        else:
            lines = lines.withColumn("_line", F.monotonically_increasing_id()).join(known, _SPLIT, "left")
            lines = lines.repartition("fid", "at").sortWithinPartitions("fid", "at", "_line")
        lines = lines.select(*_SPLIT, "state", "owner", "charset", "value")
        rows = lines.mapInPandas(_join(sep), "fid bigint, charset int, at bigint, first boolean, owner bigint, raw binary")
        whole = F.col("owner").isNull()
        rows = stage(rows.withColumns({"record": F.when(whole, text), "raw": F.when(~whole, F.col("raw"))}), "csv-records")
        # at most two parts of a split
        parts = rows.where(~whole).groupBy("fid", "owner").agg(
            F.min("charset").alias("charset"), F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("at", "raw"))).alias("p")
        )
        glue = F.aggregate("p", F.lit(None).cast("binary"), lambda a, x: F.when(a.isNull(), x["raw"]).otherwise(F.concat(a, F.lit(b"\n"), x["raw"])))
        parts = stage(parts.select("charset", "first", glue.alias("raw")).withColumn("record", text).drop("raw"), "csv-crossing")
    got = rows.where(whole).select("charset", "first", "record").unionByName(parts)
    bare = F.when(F.endswith(F.col("record"), F.lit("\r")), F.substr(F.col("record"), F.lit(1), F.length("record") - 1)).otherwise(F.col("record"))
    return got.select("charset", "first", bare.alias("record")).where("record <> ''")
