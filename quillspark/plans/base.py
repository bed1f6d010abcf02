"""Registry of runnable queries and the tables they are bound to.

A query is registered once, next to the SQL that checks it. ``documents`` plays
the review table (``lang`` is the domain), ``labels`` the gold labels,
``events`` the prediction and latency log, ``orders`` / ``lineitem`` the large
inputs of drift and quality checks, ``embeddings`` the sentence vectors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# --- tables --------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id").withColumnRenamed("lang", "domain")


def gold(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))


def labelled(spark, sf_dir) -> DataFrame:
    """(doc_id, text, domain, source, label)"""
    d = documents(spark, sf_dir).select("doc_id", "text", "domain", "source")
    return d.join(gold(spark, sf_dir), "doc_id")


def predictions(spark, sf_dir) -> DataFrame:
    """Event log read as a prediction log: (id, domain, label, prob, pred, ts)."""
    e = table(spark, sf_dir, "events")
    prob = F.col("value") / (F.col("value") + F.lit(20.0))
    return e.select(
        F.col("event_id").alias("id"), F.concat(F.lit("d"), F.col("user_id") % 4).alias("domain"),
        F.col("event_type").isin("purchase", "signup").cast("int").alias("label"), prob.alias("prob"),
        (prob >= 0.5).cast("int").alias("pred"), F.col("ts").cast("timestamp").alias("ts"), "event_type", "value",
    )


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- SQL pieces of the checks ------------------------------------------------------

LAB = """lab as (select d.doc_id, d.text, d.lang as domain, d.source, cast(l.quality as integer) as label
  from documents d join labels l using (doc_id))"""
PRED = """pred as (select event_id as id, concat('d', user_id % 4) as domain,
  cast(event_type in ('purchase', 'signup') as integer) as label, value / (value + 20.0::double) as prob,
  cast(value / (value + 20.0::double) >= 0.5 as integer) as pred, ts, event_type, value from events)"""


def h(id_sql: str = "doc_id", seed: int | str = 42) -> str:
    return f"md5(concat(cast({id_sql} as varchar), '-{seed}'))"


def rank(keys: str, id_sql: str = "doc_id", seed: int | str = 42) -> str:
    part = f"partition by {keys} " if keys else ""
    return f"row_number() over ({part}order by {h(id_sql, seed)}, {id_sql})"


def hint(key: str) -> str:
    return f"cast('0x' || substr({key}, 1, 7) as bigint)"


def count_words(words: list[str], text: str = "lower(text)") -> str:
    return "(" + " + ".join(f"cast(contains({text}, '{w}') as integer)" for w in words) + ")"


def any_word(words: list[str], text: str = "text") -> str:
    return "(" + " or ".join(f"contains({text}, '{w}')" for w in words) + ")"


TOKENS = r"string_split_regex(lower(text), '[^\p{L}\p{N}_]+')"
