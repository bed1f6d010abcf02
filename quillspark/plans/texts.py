"""Queries: cleaning, tokens, scalar text functions, schema resolution."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import schema as S
from ..operators.features import token_rows
from .base import LAB, TOKENS, any_word, count_words, documents, gold, labelled, query, rounded, table
from .weak import NEG, POS

STOP = ["the", "of", "and", "de", "la", "der", "die", "que", "in"]
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)


@query(
    "txt_simple_clean",
    r"select doc_id, regexp_replace(translate(coalesce(text, ''), chr(13) || chr(10), '  '), '^\s+|\s+$', '', 'g') as text from documents",
)
def simple_clean(spark, d):
    return documents(spark, d).select("doc_id", T.simple_clean(F.col("text")).alias("text"))


@query("txt_decode_escapes", "select doc_id, text, length(text) as n from documents")
def decode(spark, d):
    # Each letter outside ASCII is written as a literal escape, then decoded back.
    escaped = F.col("text")
    for ch in "éèêçàñíóúöäüßÉÈÊÇÀÑÍÓÚÖÄÜ":
        escaped = F.replace(escaped, F.lit(ch), F.lit("\\u%04x" % ord(ch)))
    df = documents(spark, d).select("doc_id", escaped.alias("text"))
    return df.select("doc_id", T.decode_escapes(F.col("text")).alias("text")).withColumn("n", F.length("text").cast("bigint"))


@query("txt_strip_control", r"select doc_id, regexp_replace(text, '[\x00-\x1f\x7f-\x{9f}]', '', 'g') as text from documents")
def strip_control(spark, d):
    return documents(spark, d).select("doc_id", T.strip_control(F.col("text")).alias("text"))


@query("txt_nfkc", "select doc_id, text from documents")
def nfkc(spark, d):
    # Texts are widened to full-width ASCII first; both ways back must agree.
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
    plain = "".join(chr(c) for c in range(0x21, 0x7F))
    df = documents(spark, d).select("doc_id", F.translate("text", plain, wide).alias("wide"))
    back, folded = T.nfkc(F.col("wide")), T.fold_fullwidth(F.col("wide"))
    return df.select("doc_id", F.when(back == folded, back).alias("text"))


@query(
    "txt_lengths",
    r"select doc_id, cast(length(text) as integer) as char_len, cast(len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) as integer) as word_count from documents",
)
def lengths(spark, d):
    from ..operators.profile import text_lengths

    return text_lengths(documents(spark, d))


@query("txt_truncate", "select doc_id, case when length(text) > 10 then concat(left(text, 10), '...') else text end as text from documents")
def truncate(spark, d):
    return documents(spark, d).select("doc_id", T.truncate_display(F.col("text")).alias("text"))


_TOK = f"list_filter({TOKENS}, lambda x: length(x) >= 1 and x not in ({STOP_SQL}))"
_TOK2 = f"list_filter({TOKENS}, lambda x: length(x) >= 2 and x not in ({STOP_SQL}))"


@query("txt_tokenize_join", f"select doc_id, array_to_string({_TOK}, ' ') as tokens_join, cast(len({_TOK}) as integer) as n_tokens from documents")
def tokenize(spark, d):
    df = documents(spark, d).select("doc_id", T.tokenize(F.col("text"), STOP).alias("tokens"))
    return df.select("doc_id", T.join_tokens(F.col("tokens")).alias("tokens_join"), F.size("tokens").alias("n_tokens"))


@query("txt_tokenize_min2", f"select doc_id, cast(len({_TOK2}) as integer) as n_tokens, {_TOK2}[1] as first_token from documents")
def tokenize2(spark, d):
    df = documents(spark, d).select("doc_id", T.tokenize(F.col("text"), STOP, 2).alias("tokens"))
    return df.select("doc_id", F.size("tokens").alias("n_tokens"), F.try_element_at("tokens", F.lit(1)).alias("first_token"))


@query(
    "txt_tokens_from_join",
    f"with t as (select doc_id, unnest(list_filter(string_split(array_to_string({_TOK2}, ' '), ' '), lambda x: x <> '')) as term from documents) "
    "select term, count(*) as n from t group by 1",
)
def tokens_from_join(spark, d):
    joined = documents(spark, d).select("doc_id", T.join_tokens(T.tokenize(F.col("text"), STOP, 2)).alias("j"))
    return joined.select(F.explode(T.split_joined(F.col("j"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


@query(
    "txt_bigrams",
    f"""with t as (select {_TOK2} as ts from documents),
g as (select unnest(ts) as term from t union all
  select unnest(list_transform(list_zip(ts[1:len(ts) - 1], ts[2:len(ts)]), lambda p: concat(p[1], ' ', p[2]))) from t where len(ts) > 1)
select term, count(*) as n from g group by 1""",
)
def bigrams(spark, d):
    df = documents(spark, d).select("text")
    return token_rows(df, keep=[], min_len=2, stopwords=STOP, ngrams=True).groupBy("term").agg(F.count("*").alias("n"))


@query(
    "txt_presence_count",
    f"select doc_id, {count_words(POS)} as pos_count, {count_words(NEG)} as neg_count, {any_word(NEG)} as any_neg from documents",
)
def presence(spark, d):
    t = F.col("text")
    return documents(spark, d).select(
        "doc_id", T.presence_count(t, POS).alias("pos_count"), T.presence_count(t, NEG).alias("neg_count"), T.contains_any(t, NEG).alias("any_neg")
    )


@query(
    "txt_emoji_to_word",
    "select doc_id, regexp_replace(regexp_replace(text, '[#]', 'hash', 'g'), '[$%]', 'sign', 'g') as text from documents",
)
def emoji(spark, d):
    classes = [("[#]", "hash"), ("[$%]", "sign")]
    return documents(spark, d).select("doc_id", T.emoji_to_word(F.col("text"), classes).alias("text"))


@query("txt_count_char", "select doc_id, cast(length(text) - length(replace(text, '!', '')) as integer) as n from documents")
def count_char(spark, d):
    return documents(spark, d).select("doc_id", T.count_char(F.col("text"), "!").alias("n"))


@query("txt_label_word", "select doc_id, case when quality = 1 then '正面' else '负面' end as label_word from labels")
def label_word(spark, d):
    return gold(spark, d).select("doc_id", T.label_word(F.col("label")).alias("label_word"))


# --- schema -------------------------------------------------------------------------


def _stats_sql(tbl, cols, text):
    return " union all ".join(
        f"select '{c}' as \"column\", count(*) as rows, count(distinct {c}) as n_distinct, "
        f"{'round(avg(length(' + c + ')), 6)' if c in text else 'cast(null as double)'} as mean_len from {tbl}"
        for c in cols
    )


_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
_STATS = _stats_sql("documents", _COLS, ["text", "lang", "source"])


@query("sch_column_statistics", _STATS)
def column_statistics(spark, d):
    return rounded(S.column_statistics(table(spark, d, "documents")), "mean_len")


@query(
    "sch_label_candidates",
    f"with s as ({_STATS}) select \"column\", n_distinct, cast(row_number() over (order by n_distinct, \"column\") as integer) as choice "
    "from s where n_distinct / rows < 0.2 and n_distinct <= 50",
)
def label_candidates(spark, d):
    return S.label_candidates(S.column_statistics(table(spark, d, "documents"))).select("column", "n_distinct", "choice")


@query("sch_longest_text", f"with s as ({_STATS}) select \"column\", mean_len from s where mean_len is not null order by 2 desc, 1 limit 1")
def longest_text(spark, d):
    return rounded(S.longest_text_column(S.column_statistics(table(spark, d, "documents"))), "mean_len")


@query("sch_canonical", f"with {LAB} select doc_id, text, label, domain from lab where text is not null and label is not null")
def canonical(spark, d):
    return S.canonical(labelled(spark, d), text="text", label="label", id_col="doc_id", domain="domain")


@query(
    "sch_filters",
    f"with {LAB} select doc_id, label, domain from lab where label = 1 and domain in ('en', 'de') "
    "and doc_id not in (select doc_id from labels where toxic = 1)",
)
def filters(spark, d):
    toxic = table(spark, d, "labels").where("toxic = 1").select("doc_id")
    lab = labelled(spark, d).where((F.col("label") == 1) & F.col("domain").isin("en", "de"))
    return lab.join(toxic, "doc_id", "left_anti").select("doc_id", "label", "domain")


@query(
    "sch_drop_blank_duplicates",
    r"""with c as (select doc_id, regexp_replace(translate(text, chr(13) || chr(10), '  '), '^\s+|\s+$', '', 'g') as t from documents)
select min(doc_id) as doc_id from c where t <> '' group by t""",
)
def drop_duplicates(spark, d):
    return S.drop_blank_and_duplicate(documents(spark, d)).select("doc_id")


@query(
    "sch_shape",
    " union all ".join(
        f"select '{t}' as dataset, count(*) as rows, cast({len(c)} as bigint) as n_columns, '{','.join(c)}' as columns from {t}"
        for t, c in (("documents", _COLS), ("labels", ["doc_id", "quality", "toxic"]), ("conversations", ["conv_id", "turn", "role", "text"]))
    ),
)
def shape(spark, d):
    from ..operators.profile import shape as shape_of

    return shape_of({t: table(spark, d, t) for t in ("documents", "labels", "conversations")})


@query(
    "src_sidecar_labels",
    """with n as (select (select count(*) from documents) as a, (select count(*) from labels) as b)
select d.doc_id, case when n.a = n.b then cast(l.quality as integer) end as label, cast(l2.sidecar as integer) as aligned
from documents d cross join n left join labels l using (doc_id) left join (select doc_id, doc_id % 2 as sidecar from documents) l2 using (doc_id)""",
)
def sidecar(spark, d):
    docs = documents(spark, d).select("doc_id", "text")
    refused = S.attach_sidecar(docs, gold(spark, d))  # row counts differ
    full = documents(spark, d).select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label"))
    taken = S.attach_sidecar(docs, full).select("doc_id", F.col("label").alias("aligned"))
    return refused.select("doc_id", "label").join(taken, "doc_id")


@query(
    "src_domain_registry",
    "select lang as domain, source, count(*) as n from documents where lang in ('en', 'fr') group by 1, 2",
)
def registry(spark, d):
    from ..sources.registry import Registry

    reg = Registry().add("reviews", lambda s: documents(s, d), domain_col="domain")
    return reg.load(spark, "reviews", domains=["en", "fr"]).groupBy("domain", "source").agg(F.count("*").alias("n"))


# --- files ------------------------------------------------------------------------------


@query("src_csv_round_trip", "select cast(doc_id as varchar) as doc_id, text, lang as domain from documents")
def csv_round_trip(spark, d):
    """Reviews written as CSV and read back through the charset ladder."""
    from ..session import staging_path
    from ..sources import reviews as RV, sinks as SK

    path = staging_path(spark, "reviews-csv")
    SK.write_table(documents(spark, d).select("doc_id", "text", "domain"), path, fmt="csv")
    return RV.read_reviews(spark, path)


@query(
    "src_mixed_charsets",
    """select cast(doc_id as varchar) as doc_id, concat(text, chr(10), '"', source, '", 评论') as text, lang as domain from documents""",
)
def mixed_charsets(spark, d):
    """Records over several lines, half of the files in UTF-8 and half in
    GB18030, read back as one table."""
    from ..session import staging_path
    from ..sources import records as RC, reviews as RV, sinks as SK

    text = F.concat("text", F.lit('\n"'), "source", F.lit('", 评论')).alias("text")
    docs = documents(spark, d).select("doc_id", text, "domain")
    path = staging_path(spark, "reviews-charsets")
    with RC.lenient(spark):
        for i, charset in enumerate(("UTF-8", "GB18030")):
            SK.write_table(docs.where(F.col("doc_id") % 2 == i), f"{path}/{charset}", fmt="csv", encoding=charset)
    return RV.read_reviews(spark, [f"{path}/UTF-8", f"{path}/GB18030"])


@query("src_partitioned_table", "select source, count(*) as n, cast(sum(n_chars) as bigint) as chars from documents where lang = 'de' group by 1")
def partitioned_table(spark, d):
    """A table partitioned by domain; one domain reads one folder."""
    from ..session import staging_path
    from ..sources import sinks as SK

    path = staging_path(spark, "reviews")
    SK.write_table(documents(spark, d).select("source", "n_chars", "domain"), path, partition_by=["domain"])
    return spark.read.parquet(path).where("domain = 'de'").groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query(
    "src_json_statistics",
    """select '{"domain":"' || lang || '","nrows":' || count(*) || '}' as json from documents group by lang""",
)
def json_statistics(spark, d):
    from ..sources import sinks as SK

    return SK.as_json(documents(spark, d).groupBy("domain").agg(F.count("*").alias("nrows")))


@query("src_vectors", "select vec_id, round(list_sum(embedding::double[]), 5) as total, cast(len(embedding) as integer) as dims from embeddings")
def vectors(spark, d):
    from ..session import staging_path
    from ..sources import sinks as SK

    path = staging_path(spark, "vectors")
    SK.write_vectors(table(spark, d, "embeddings"), path)
    e = spark.read.parquet(path)
    return rounded(
        e.select("vec_id", F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")).alias("total"), F.size("embedding").alias("dims")),
        "total", digits=5,
    )
