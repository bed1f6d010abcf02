"""Parsing of model responses and triplet strings, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import lexicons as lx

TRIPLETS = "array<struct<aspect:string,opinion:string,sentiment:string>>"


def sentiment_of_response(response: Column) -> Column:
    """1, 0 or -1; the first test that holds decides."""
    r, low = response, F.lower(response)
    out = (
        F.when(r.contains("正面"), 1)
        .when(r.contains("负面"), 0)
        .when(low.contains("positive") | r.contains("好"), 1)
        .when(low.contains("negative") | r.contains("差"), 0)
        .otherwise(-1)
    )
    return out.cast("int")


def strip_fence(response: Column) -> Column:
    """The body of a ``` block (without a language tag), else the text."""
    t = F.trim(response)
    body = F.regexp_replace(F.element_at(F.split(t, "```"), 2), r"^json", "")
    return F.trim(F.when(t.startswith("```"), body).otherwise(t))


def triplets_of_response(response: Column) -> Column:
    """Array of triplets; items without aspect or sentiment are dropped, and
    anything that is not a JSON array gives an empty array."""
    items = F.from_json(strip_fence(response), "array<map<string,string>>")
    named = F.filter(
        items, lambda m: m.isNotNull() & F.map_contains_key(m, F.lit("aspect")) & F.map_contains_key(m, F.lit("sentiment"))
    )
    shaped = F.transform(
        named,
        lambda m: F.struct(
            F.try_element_at(m, F.lit("aspect")).alias("aspect"),
            F.coalesce(F.try_element_at(m, F.lit("opinion")), F.lit("")).alias("opinion"),
            F.try_element_at(m, F.lit("sentiment")).alias("sentiment"),
        ),
    )
    return F.coalesce(shaped, F.array().cast(TRIPLETS))


def analysis_of_response(response: Column) -> Column:
    """Struct of reason, analysis and fix; text that is not JSON becomes the
    analysis of a fallback struct."""
    parsed = F.from_json(response, "error_reason string, detailed_analysis string, suggested_fix string")
    field = lambda n: F.coalesce(parsed.getField(n), F.lit(""))
    good = F.struct(field("error_reason").alias("error_reason"), field("detailed_analysis").alias("detailed_analysis"), field("suggested_fix").alias("suggested_fix"))
    bad = F.struct(
        F.lit(lx.ERROR_FALLBACK_REASON).alias("error_reason"), response.alias("detailed_analysis"), F.lit(lx.ERROR_FALLBACK_FIX).alias("suggested_fix")
    )
    return F.when(F.try_parse_json(response).isNotNull(), good).otherwise(bad)


def gold_triplets(s: Column) -> Column:
    """Distinct triplets of a ``a,o,p;a,o,p`` string or of a JSON list of
    three-item lists, each in the form ``a,o,p``; bad input gives none."""
    plain = F.filter(F.split(s, ";"), lambda x: x != "")
    # A list literal may use parentheses and single quotes; apostrophes inside
    # of an item stay.
    opened = F.regexp_replace(s, r"""\(\s*(?=['"])""", "[")
    closed = F.regexp_replace(opened, r"""(?<=['"])\s*,?\s*\)""", "]")
    as_json = F.regexp_replace(closed, r"(?<=[\[,]\s{0,8})'|'(?=\s*[,\]])", '"')
    listed = F.transform(F.from_json(as_json, "array<array<string>>"), lambda t: F.array_join(t, ","))
    none = F.array().cast("array<string>")
    out = F.when(s.isNull() | (s == ""), none).when(s.startswith("["), listed).otherwise(plain)
    return F.array_distinct(F.coalesce(out, none))
