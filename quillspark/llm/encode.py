"""Token ids of whole texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType
from tokenizers import Tokenizer, pre_tokenizers

#: Fixed values of the vocabulary: where its pre-tokeniser cuts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space after a character that is no white space always begins a new pre-token.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_RUN = re.compile(r"\s ")
#: A line end between two such characters is a pre-token of its own, and the word behind it has no space.
_LINE = re.compile(r"(?<=\S)\n(?=\S)")
_SPACES = re.compile(r"\s\s")
_LATIN = "\u0250"
_LONG = 64
_ENTRIES = 1_000_000
_SLICE = 256


class _Words(dict):
    """Ids of a space and a word, by word; a new word is encoded when it is asked for.

    A word that begins with a line end has no space before it.
    """

    def __init__(self, tokenizer) -> None:
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.cut = regex.compile(PATTERN).findall
        self.parts: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        # the vocabulary writes each byte as one character; bytes above 127 appear in Latin letters
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.level = {}
        for i in range(ord(_LATIN)):
            self.level.update(zip(chr(i).encode(), shown(chr(i))[0][0]))
        self.space = self.level[ord(" ")]
        self.packed = [i.to_bytes(4, "little") for i in range(max(tokenizer.get_vocab().values(), default=0) + 1)]

    def ids(self, shown: str) -> bytes:
        """Ids of a pre-token in the characters of the vocabulary."""
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(shown)])

    def shown(self, pre_token: str) -> str:
        return pre_token.encode().decode("latin-1").translate(self.level)

    def part(self, pre_token: str) -> bytes:
        """Ids of one pre-token of Latin letters, digits or signs."""
        got = self.parts.get(pre_token)
        if got is None:
            got = self.parts[pre_token] = self.ids(self.shown(pre_token))
        return got

    def whole(self, text: str) -> bytes:
        got = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(got.ids, "<u4").tobytes()

    def first(self, word: str) -> bytes:
        """Ids of the word that a text begins with: no space stands before it."""
        if not word or len(word) > _LONG or max(word) >= _LATIN:
            return self.whole(word)
        if word.isalpha():
            return self.part(word)
        return b"".join([self.part(p) for p in self.cut(word)])

    def age(self) -> None:
        """Forget the words that were not asked for since the last call."""
        self.before = dict(self)
        self.clear()

    def __missing__(self, word: str) -> bytes:
        if (got := self.before.get(word)) is not None:
            self[word] = got
            return got
        if word[:1] == "\n":
            got = self.part("\n") + self.first(word[1:])
            if len(word) <= _LONG:
                self[word] = got
            return got
        ascii_ = word.isascii()
        if not word or len(word) > _LONG or (not ascii_ and max(word) >= _LATIN):
            return self.whole(" " + word)
        if word.isalpha():
            got = self.ids(self.space + word if ascii_ else self.shown(" " + word))  # ASCII letters are shown as they are
        elif word[-1] in ".," and word[:-1].isalpha():
            got = self[word[:-1]] + self.part(word[-1])
        else:
            got = b"".join([self.part(p) for p in self.cut(" " + word)])
        self[word] = got
        return got


class Encoder:
    """Encodes texts with the tokenizers library, each distinct word once.

    Texts are cut before single spaces, where the pre-tokeniser cuts as well,
    so the ids of a text are the ids of its words. Latin words go to the BPE
    model of the library by pre-token, all others through the whole tokenizer.
    A bounded number of words is kept between texts.
    """

    def __init__(self, path: str, entries: int = _ENTRIES) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.entries = entries
        self.words = _Words(self.tokenizer)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null is an empty text."""
        words, out = self.words, []
        get, first = words.__getitem__, words.first
        for text in texts:
            if not text:
                out.append(b"")
                continue
            if _SPACES.search(text) is None:
                pieces = text.replace("\n", " \n").split(" ")
            else:
                pieces = _CUT.split(text) if " \n" in text or _RUN.search(text) else _LINE.sub(" \n", text).split(" ")
            out.append(first(pieces[0]) + b"".join(map(get, pieces[1:])))
        if len(words) > self.entries // 2:
            words.age()
        if len(words.parts) > self.entries // 4:
            words.parts.clear()
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path)


def encode_table(batches: Iterator[pa.RecordBatch], path: str, text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with the ids of their texts."""
    enc = encoder(path)
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE):
            part = batch.slice(at, _SLICE)
            yield part, enc.encode(part.column(text).to_pylist())


def encode_ids(df: DataFrame, path: str, end_id: int, text: str = "text", ids: str = "ids") -> DataFrame:
    """Replace the text by its ids and an end id (binary, 4 bytes an id, little-endian).

    A null or empty text gives the end id alone. Texts are encoded whole; other
    columns pass through.
    """
    others = [c for c in df.columns if c != text]
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in encode_table(batches, path, text):
            columns = [part.column(c) for c in others] + [pa.array([x + end for x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*others, ids])

    schema = StructType([*(df.schema[c] for c in others), StructField(ids, BinaryType())])
    return df.mapInArrow(run, schema)
