"""Rewrites that take whole lines do not rescan a line from each of its characters."""

import random
import re
import time

from pyspark.sql import functions as F

from quillspark.functions import augment as A

RULES = [("(.*)( the | of )(.*)", "$1$3$2"), ("!!", "."), ("and ", "")]


def test_whole_line_rewrites_agree_and_long_lines_end(spark):
    rng = random.Random(3)
    parts = ["x", " the ", " of ", "\n", "\r\n", "\r", " ", "and ", "!!", " ", "the", "é"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 25))) for _ in range(400)] + [None, "", "\n", " of \n"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    key = F.md5(F.col("i").cast("string"))
    plain = F.col("t")
    for j, (pattern, repl) in enumerate(RULES):
        plain = F.when(A.chance(A.sub_key(key, "bt", j), 0.7), F.regexp_replace(plain, pattern, repl)).otherwise(plain)
    got = df.select(A.rewrite(F.col("t"), key, RULES, 0.7).alias("a"), plain.alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got] and any(r["a"] != t for r, t in zip(got, texts))
    line = spark.range(1).select(F.repeat(F.lit("abcdefgh "), 40_000).alias("t"))
    began = time.time()
    assert line.select((A.rewrite(F.col("t"), F.lit("k"), RULES[:1], 1.0) == F.col("t")).alias("same")).first()["same"]
    assert time.time() - began < 20  # unanchored, 360,000 characters are read 65 billion times


def test_only_whole_line_patterns_are_anchored():
    for pattern in ("!!", "(.*)a|b(.*)", r"(.*)(a)\2(.*)", "(.*)(?<=x)(.*)", "(.*)x(.*)y", "(.*)"):
        assert A._whole_lines(pattern) == pattern
    assert re.match(r"\(\?m\)\^", A._whole_lines("(.*)(a|b)c(.*)"))
