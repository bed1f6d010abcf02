"""Quality rules whose thresholds follow each language and source.

Measures are whole numbers. Their distribution per (language, source) is kept
as a mergeable quantile sketch: counts per bucket, exact up to 255 and within
1/128 beyond, so sketches of parts, of a language or of all rows are sums. Each
group's fences come from its own quartiles, or from those of its language, or
of all rows, where it has too few documents. All steps are DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage
from .common import SPACES, let

_BLANK = r"[\x20\x09-\x0D]+"
#: Measure: (what it is per thousand or hundred of, fenced below too, least quartile distance).
MEASURES = {"symbols": (False, 20), "repeats": (False, 100), "dup_lines": (False, 200), "word_length": (True, 60)}


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in an array of words.

    Window hashes are packed with their positions into numbers and sorted, so
    the work is n log n per text. The position takes as many bits as the text
    needs; at least 40 bits stay for the hash up to 16 million words.
    """
    n = F.size(words)
    bits = F.length(F.bin(n.cast("long")))
    up = lambda x, b: F.call_function("shiftleft", x, b)
    down = lambda x, b: F.call_function("shiftright", x, b)

    def packed(i: Column) -> Column:
        key = F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
        return up(key, bits).bitwiseOR(i.cast("long"))

    def covered(s: Column) -> Column:
        def twice(x: Column, k: Column) -> Column:
            me = down(x, bits)
            return F.coalesce(me == down(F.get(s, k - 1), bits), F.lit(False)) | F.coalesce(me == down(F.get(s, k + 1), bits), F.lit(False))

        at = F.sort_array(F.transform(F.filter(s, twice), lambda x: x.bitwiseAND(up(F.lit(1).cast("long"), bits) - 1)))
        start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(at, start, lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n")), lambda a: a["n"])

    keys = F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), packed))
    return F.when(n >= 4, let(keys, covered)).otherwise(F.lit(0).cast("long"))


def measure(df: DataFrame, text: str = "text", *keep: str) -> DataFrame:
    """Counts of each whole text; null counts as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    chars = F.char_length(t)
    bare = F.btrim(t, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _BLANK))
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("repeat")))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    got = df.select(
        *keep, of_words.alias("_w"), of_lines.alias("_l"), F.char_length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (chars - F.char_length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
    )
    return got.select(
        *keep, F.col("_w.n").alias("n_words"), "word_chars", "n_symbols", F.col("_l.n").alias("n_lines"), F.col("_l.dup").alias("n_dup_lines"), F.col("_w.repeat").alias("n_repeat_words")
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _share(per: int, part: str, whole: str) -> Column:
    return F.floor(F.col(part) * per / F.greatest(F.col(whole), F.lit(1))).cast("long")


def shares() -> dict[str, Column]:
    return {
        "symbols": _share(1000, "n_symbols", "word_chars"), "repeats": _share(1000, "n_repeat_words", "n_words"),
        "dup_lines": _share(1000, "n_dup_lines", "n_lines"), "word_length": _share(100, "word_chars", "n_words"),
    }


def bucket(v: Column) -> Column:
    """The lower end of a value's bucket: 8 leading binary digits are kept."""
    cut = F.greatest(F.length(F.bin(v)) - 8, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, cut), cut)


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): a sketch per group; sketches merge by adding n."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), bucket(v).alias("bucket")) for m, v in shares().items()])
    rows = measured.select("lang", "source", F.explode(pairs).alias("p"))
    return rows.groupBy("lang", "source", F.col("p.measure").alias("measure"), F.col("p.bucket").alias("bucket")).agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, *keys: str) -> DataFrame:
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, *keys: str, reach: int = 3) -> DataFrame:
    """(keys, support, lo_*, hi_*): quartiles widened by ``reach`` times their distance."""
    part = Window.partitionBy(*keys, "measure")
    upto = F.sum("n").over(part.orderBy("bucket"))
    ranked = sketches.withColumn("upto", upto).withColumn("all", F.sum("n").over(part))
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("all") * q, F.col("bucket")))
    quart = ranked.groupBy(*keys, "measure").agg(at(1).alias("q1"), at(3).alias("q3"), F.max("all").alias("support"))
    cols = []
    for m, (both, least) in MEASURES.items():
        wide = F.greatest(F.col("q3") - F.col("q1"), F.lit(least)) * reach
        low = F.col("q1") - wide if both else F.lit(0).cast("long")
        cols += [F.max(F.when(F.col("measure") == m, low)).alias(f"lo_{m}"), F.max(F.when(F.col("measure") == m, F.col("q3") + wide)).alias(f"hi_{m}")]
    return quart.groupBy(*keys).agg(F.max("support").alias("support"), *cols)


def thresholds(sketches: DataFrame, least: int = 200, reach: int = 3) -> DataFrame:
    """Fences for every (lang, source): its own, its language's, or those of all rows.

    A level with fewer than ``least`` documents leaves the choice to the next.
    """
    names = [f"{side}_{m}" for m in MEASURES for side in ("lo", "hi")]
    own = fences(sketches, "lang", "source", reach=reach)
    of_lang = fences(merge(sketches, "lang"), "lang", reach=reach).select(F.col("lang").alias("_lang"), F.struct("support", *names).alias("_l"))
    every = fences(merge(sketches.withColumn("_all", F.lit(1)), "_all"), "_all", reach=reach).select("_all", F.struct(*names).alias("_a"))
    got = own.join(of_lang, F.col("lang").eqNullSafe(F.col("_lang"))).withColumn("_all", F.lit(1)).join(every, "_all")
    pick = lambda c: F.when(F.col("support") >= least, F.col(c)).when(F.col("_l.support") >= least, F.col(f"_l.{c}")).otherwise(F.col(f"_a.{c}"))
    return got.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[pick(c).alias(c) for c in names])


def judge(df: DataFrame, least: int = 200, reach: int = 3) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for each row of (doc_id, text, lang, source).

    Null lang and source are groups of their own. A null or empty text fails
    the base rules. Documents that fail them take no part in the sketches.
    Equal rows are judged alike; an empty table gives an empty result.
    """
    measured = stage(measure(df, "text", "doc_id", "lang", "source").withColumn("base_failed", base_failed()), "rule-measures")
    sketches = stage(sketch(measured.where("not base_failed")), "rule-sketches")
    limits = stage(thresholds(sketches, least, reach), "rule-thresholds")
    inside = F.lit(True)
    for m, v in shares().items():
        inside = inside & v.between(F.col(f"lo_{m}"), F.col(f"hi_{m}"))
    limits = F.broadcast(limits) if limits.count() <= 10_000 else limits
    got = measured.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    return got.select(*measured.columns, (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"))
