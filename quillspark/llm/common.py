"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, functions as F

#: One word: a run of characters outside ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_CAPITALS = re.compile("[A-Z]+")
SPACES = " \t\n\x0b\x0c\r"


def word_count(text: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z in small letters, all other characters as they are."""
    plain = F.octet_length(text) == F.char_length(text)  # no other letters: the fast built-in does the same
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def ascii_lowered(text: str) -> str:
    """As ``ascii_lower``, for text inside a task."""
    return text.lower() if text.isascii() else _CAPITALS.sub(lambda m: m[0].lower(), text)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    A column that is used several times inside higher-order functions would be
    computed anew for each element; bound as a lambda variable it is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def hashed(column: Column, seed: int | str) -> Column:
    """A 64-bit number that depends on a value and a seed only."""
    return F.xxhash64(F.lit(str(seed)), column)


def spread_rows(df: DataFrame, rows_per_task: int = 20_000) -> DataFrame:
    """Deal out a table whose files are fewer than the cores.

    For heavy work per row on few files. Costs one count, which Parquet answers
    from its footers.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = min(cores, -(-df.count() // rows_per_task))
    return df.repartition(wanted) if wanted > 1 and len(df.inputFiles()) < wanted else df


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that all executors share."""
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, name: str, attempt: int, parts: Iterator[bytes]) -> int:
    """Write a file under a name of this attempt, then move it to its place.

    A task that runs twice leaves one whole file.
    """
    fs, folder = filesystem(uri)
    fs.create_dir(folder, recursive=True)
    draft, size = f"{folder}/_{name}.{attempt}", 0
    with fs.open_output_stream(draft, compression=None) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    fs.move(draft, f"{folder}/{name}")
    return size


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file, named by TOKENIZER_DIR or the installed package."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
