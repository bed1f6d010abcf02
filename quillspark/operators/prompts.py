"""Prompt and response tables. Calling a model is outside this library: these
operators build the text that is sent and read the text that comes back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import lexicons as lx
from ..functions.parsing import analysis_of_response, sentiment_of_response
from ..functions.templates import fill
from ..functions.text import label_word


def example_block(examples: DataFrame, *, order: str = "rank", text: str = "text", label: str = "label") -> DataFrame:
    """One row holding all few-shot examples as text, in order.

    The examples are a handful of rows by construction (n per class).
    """
    one = fill(lx.EXAMPLE_FORMAT, text=F.col(text), label=label_word(F.col(label)))
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), one.alias("s"))))
    return examples.agg(F.array_join(F.transform(listed, lambda e: e["s"]), "").alias("examples"))


def sentiment_prompts(df: DataFrame, examples: DataFrame | None = None, *, text: str = "text") -> DataFrame:
    """Adds system_prompt and user_prompt; zero-shot without examples."""
    shown = F.lit("") if examples is None else F.coalesce(examples.scalar(), F.lit(""))
    question = fill(lx.QUESTION_FORMAT, text=F.col(text))
    return df.withColumn("_shown", shown).withColumns(
        {"system_prompt": F.lit(lx.SENTIMENT_SYSTEM), "user_prompt": F.concat(F.lit(lx.EXAMPLES_HEADER), F.col("_shown"), question)}
    ).drop("_shown")


def aspect_prompts(df: DataFrame, *, text: str = "text", domain: Column | str = "domain", aspects: dict[str, str] | None = None) -> DataFrame:
    """Adds the prompts for aspect extraction; an unknown domain gets the default aspects."""
    d = F.col(domain) if isinstance(domain, str) else domain
    known = None
    for name, listed in (aspects or lx.DOMAIN_ASPECTS).items():
        known = F.when(d == name, F.lit(listed)) if known is None else known.when(d == name, F.lit(listed))
    chosen = F.coalesce(known, F.lit(lx.DEFAULT_ASPECTS))
    return df.withColumns(
        {"system_prompt": fill(lx.ASPECT_SYSTEM, aspects=chosen), "user_prompt": fill(lx.ASPECT_USER, text=F.col(text))}
    )


def parse_sentiment(df: DataFrame, *, response: str = "response") -> DataFrame:
    return df.withColumn("pred", sentiment_of_response(F.col(response)))


def validity(parsed: DataFrame, *, pred: str = "pred") -> DataFrame:
    """(n, n_valid, valid_rate) of parsed responses."""
    s = parsed.agg(F.count("*").alias("n"), F.count_if(F.col(pred) != -1).alias("n_valid"))
    return s.withColumn("valid_rate", F.when(F.col("n") > 0, F.col("n_valid") / F.col("n")))


def valid_only(parsed: DataFrame, *, pred: str = "pred") -> DataFrame:
    return parsed.where(F.col(pred) != -1)


def case_prompts(cases: DataFrame, *, max_chars: int = 100) -> DataFrame:
    """(query_id, user_prompt): an error row with its k nearest error rows.

    ``cases`` is the retrieval result with query_/neighbor_ text, label and
    pred columns: k rows per query.
    """
    word = lambda c: label_word(F.col(c))
    one = fill(
        lx.CASE_FORMAT, rank=F.col("rank"), text=F.left("neighbor_text", F.lit(max_chars)), true=word("neighbor_label"),
        pred=word("neighbor_pred"), similarity=F.format_string("%.3f", F.col("similarity")),
    )
    g = cases.groupBy("query_id", "query_text", "query_label", "query_pred").agg(
        F.array_sort(F.collect_list(F.struct("rank", one.alias("s")))).alias("_cases")
    )
    head = fill(lx.CASE_HEADER, text=F.col("query_text"), true=word("query_label"), pred=word("query_pred"), n=F.size("_cases"))
    body = F.array_join(F.transform("_cases", lambda c: c["s"]), "")
    return g.select("query_id", F.concat(head, body, F.lit(lx.CASE_FOOTER)).alias("user_prompt"))


def parse_analysis(df: DataFrame, *, response: str = "response") -> DataFrame:
    return df.withColumn("_a", analysis_of_response(F.col(response))).select("*", "_a.*").drop("_a")
