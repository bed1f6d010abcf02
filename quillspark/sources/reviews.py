"""Reading review files of unknown charset, and triplet files."""

from __future__ import annotations

import csv
import functools
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, StringType

from ..session import stage
from .records import best_charset, beyond_ascii, java_name, lenient, lines_of, misfits, read_records

# Orders in which charsets are tried; the first acceptable one is taken.
LADDER_DEFAULT = ["utf-8", "gb18030", "gbk", "gb2312"]
LADDER_LATIN = ["utf-8", "latin1"]
LADDER_BOM = ["utf-8-sig", "gbk", "gb18030"]

CORRUPT = "_malformed"


def _line_counts(spark: SparkSession, path: str | list[str], charsets: Sequence[str], *keys: str) -> DataFrame:
    """(keys, lines, other, bad): lines, those beyond plain ASCII, and those
    with undecodable bytes for each charset. One scan for all charsets."""
    lines = lines_of(spark, path).where(F.length(F.btrim(F.col("value").cast("string"), F.lit("\r"))) > 0)
    bad = F.array(*[F.count_if(x) for x in misfits(charsets)])
    with lenient(spark):
        return stage(lines.groupBy(*keys).agg(F.count("*").alias("lines"), F.count_if(beyond_ascii()).alias("other"), bad.alias("bad")), "csv-charsets")


def charset_scores(spark: SparkSession, path: str, charsets: Sequence[str] = LADDER_DEFAULT) -> DataFrame:
    """(charset, position, lines, bad_share): lines with undecodable bytes.

    Bytes that do not fit a charset decode to U+FFFD, so no charset fails
    outright; the share of such lines tells them apart.
    """
    names = F.array(*[F.lit(c) for c in charsets])
    return _line_counts(spark, path, charsets).select("lines", F.posexplode("bad").alias("position", "n")).select(
        F.get(names, F.col("position")).alias("charset"), "position", "lines", (F.col("n") / F.greatest(F.col("lines"), F.lit(1))).alias("bad_share")
    )


def detect_charset(spark: SparkSession, path: str, charsets: Sequence[str] = LADDER_DEFAULT, *, limit: float = 0.0) -> str:
    """First charset of the ladder whose bad share is within the limit, else
    the one with the smallest share."""
    shares = charset_scores(spark, path, charsets).orderBy("position").collect()  # one row a charset
    fits = [r["charset"] for r in shares if r["bad_share"] <= limit]
    return fits[0] if fits else min(shares, key=lambda r: (r["bad_share"], r["position"]))["charset"]


def file_charsets(spark: SparkSession, path: str | list[str], charsets: Sequence[str] = LADDER_DEFAULT, *, tolerance: float = 0.05) -> DataFrame:
    """(file, charset, lines, bad_share): the charset of each file of a path.

    It is the first of the ladder whose share of undecodable lines, among the
    lines that are not plain ASCII, exceeds the smallest share of all charsets
    by no more than the tolerance: a stray byte does not make a UTF-8 file
    Latin-1. Files without a line have no row.
    """
    shares = F.transform("bad", lambda x: x / F.greatest(F.col("other"), F.lit(1)))
    got = _line_counts(spark, path, charsets, "file").withColumn("shares", shares).withColumn("i", best_charset(F.col("shares"), tolerance))
    return got.select("file", F.get(F.array(*[F.lit(c) for c in charsets]), F.col("i")).alias("charset"), "lines", F.get("shares", F.col("i")).alias("bad_share"))


def header_names(spark: SparkSession, path: str | list[str], charset: str, sep: str = ",") -> list[str]:
    return spark.read.csv(path, header=True, encoding=java_name(charset), sep=sep).columns


def _by_charset(spark: SparkSession, path: str | list[str], charsets: Sequence[str]) -> list[tuple[str, str | list[str]]]:
    """Charsets with their files; the whole path where all files agree."""
    if len(charsets) == 1:
        return [(charsets[0], path)]
    found = file_charsets(spark, path, charsets)
    used = [r["charset"] for r in found.select("charset").distinct().collect()]
    if len(used) < 2:
        return [(used[0] if used else charsets[0], path)]
    # file names only, as the driver lists them for any scan
    files = {c: sorted(unquote(r["file"]) for r in found.where(F.col("charset") == c).select("file").collect()) for c in used}
    return sorted(files.items(), key=lambda x: charsets.index(x[0]))


def read_reviews(
    spark: SparkSession, path: str | list[str], *, charsets: Sequence[str] = LADDER_DEFAULT, schema: StructType | str | None = None,
    header: bool = True, sep: str = ",", keep_malformed: bool = False, multi_line: bool = True,
) -> DataFrame:
    """A review CSV, a folder or a list of them, each file in its own charset. Records
    that do not fit the header are left out, or kept in ``_malformed`` so that
    they can be counted (``malformed_counts``).

    Quoted records may span lines, and a large file is read by many tasks all
    the same (``records``). ``multi_line=False`` is for files known to have a
    record per line: it needs no staged table. Columns are read as text unless
    a schema is given.
    """
    if multi_line:
        df = _read_spanning(spark, path, charsets, schema, header, sep)
    else:
        df = _read_lines(spark, path, charsets, schema, header, sep)
    return df if keep_malformed else df.where(F.col(CORRUPT).isNull() & _parsed(df)).drop(CORRUPT)


def _with_corrupt(names: Sequence[str], schema: StructType | str | None) -> StructType:
    if schema is None:
        schema = StructType([StructField(n.lstrip("\ufeff"), StringType()) for n in names])
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def _read_spanning(spark, path, charsets, schema, header, sep) -> DataFrame:
    rows = read_records(spark, path, charsets, sep=sep)
    names = ["review"]
    if header and schema is None:
        top = rows.where("first").orderBy("charset", "record").first()
        names = column_names(next(csv.reader([top["record"]], delimiter=sep))) if top else names
    if header:
        rows = rows.where("not first")
    full = _with_corrupt(names, schema)
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": "true", "maxCharsPerColumn": "-1"}
    # one row each; a filter on it does not parse the record a second time
    return rows.select(F.inline(F.array(F.from_csv("record", full.simpleString(), options))))


def column_names(cells: Sequence[str]) -> list[str]:
    """Names of a header: empty ones by place, repeated ones with their place."""
    low = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if low.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def _read_lines(spark, path, charsets, schema, header, sep) -> DataFrame:
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # the scan itself runs later
    groups = _by_charset(spark, path, charsets)
    names = header_names(spark, groups[0][1], groups[0][0], sep) if header and schema is None else ["review"]
    full = _with_corrupt(names, schema)

    def read(charset: str, files: str | list[str]) -> DataFrame:
        # Without this a query of few columns would not see surplus fields.
        return spark.read.option("columnPruning", False).csv(
            files, schema=full, header=header, sep=sep, encoding=java_name(charset), mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
            multiLine=False, escape='"', enforceSchema=True,
        )

    return functools.reduce(DataFrame.unionByName, [read(c, files) for c, files in groups])


def _parsed(df: DataFrame):
    """Always true, but needs a data column: Spark refuses a CSV scan that asks
    for the malformed column alone, as a plain count would."""
    return F.length(F.coalesce(F.col(df.columns[0]).cast("string"), F.lit(""))) >= 0


def malformed_counts(df: DataFrame) -> DataFrame:
    """(rows, malformed) of a table read with ``keep_malformed``."""
    return df.agg(F.count_if(_parsed(df)).alias("rows"), F.count(CORRUPT).alias("malformed"))


def read_triplets(spark: SparkSession, path: str) -> DataFrame:
    """TSV with a header: text, triplets."""
    return spark.read.csv(path, sep="\t", header=True, schema="text string, triplets string", quote="")


def read_stopwords(spark: SparkSession, path: str | None, default: Sequence[str]) -> list[str]:
    """Stop words from a text file, one per line; the default without a file.

    The list is used inside expressions, so it is held on the driver; a file
    of more than 100,000 words is refused.
    """
    if path is None:
        return list(default)
    rows = spark.read.text(path).select(F.trim("value").alias("w")).where("w <> ''").distinct().limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("stop word file too large")
    return sorted(r["w"] for r in rows)
