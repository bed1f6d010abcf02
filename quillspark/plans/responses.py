"""Queries: prompts, responses, aspect triplets."""

from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions.templates import fill
from ..operators import metrics as M, prompts as P, retrieval as R, sampling as S, splits as SP, triplets as T
from ..session import stage
from .base import LAB, TOKENS, documents, gold, labelled, query, rank, rounded, table
from .sampling import _R, _TEST
from .search import _CASES, _N, _top_sql, error_cases, vectors

_W = lambda c: f"case when {c} = 1 then '正面' else '负面' end"


def _lit(s):
    return "'" + s.replace("'", "''") + "'"


def _fill_sql(template, **values):
    import re

    parts = re.split(r"\{(" + "|".join(values) + r")\}", template)
    return " || ".join(f"cast({values[p]} as varchar)" if i % 2 else _lit(p) for i, p in enumerate(parts) if i % 2 or p)


_QUESTION = _fill_sql(lx.QUESTION_FORMAT, text="text")


@query("prompt_zero_shot", f"select doc_id, {_lit(lx.SENTIMENT_SYSTEM)} as system_prompt, {_lit(lx.EXAMPLES_HEADER)} || {_QUESTION} as user_prompt from documents")
def zero_shot(spark, d):
    return P.sentiment_prompts(documents(spark, d)).select("doc_id", "system_prompt", "user_prompt")


@query(
    "prompt_few_shot",
    f"""with {LAB}, {_R}, test as (select doc_id, text from r where rk <= {_TEST}), x as (select label, left(text, 100) as text, {rank('label')} as k from lab where doc_id not in (select doc_id from test)),
ex as (select string_agg({_fill_sql(lx.EXAMPLE_FORMAT, text='text', label=_W('label'))}, '' order by 10 * (1 - label) + k) as s from x where k <= 2)
select doc_id, {_lit(lx.EXAMPLES_HEADER)} || s || {_QUESTION} as user_prompt from test cross join ex""",
)
def few_shot(spark, d):
    lab = labelled(spark, d).select("doc_id", "label", "text")
    test = SP.stratified_holdout(lab).where("split = 'test'")
    shots = S.few_shot_examples(lab, test, 5)
    from ..functions.hashing import hash_key

    ordered = shots.withColumn("rank", F.struct((1 - F.col("label")).alias("side"), hash_key("doc_id", 42).alias("h"), "doc_id"))
    return P.sentiment_prompts(test, P.example_block(ordered)).select("doc_id", "user_prompt")


_ASPECTS = {"en": lx.DOMAIN_ASPECTS["hotel"], "de": lx.DOMAIN_ASPECTS["food"], "fr": lx.DOMAIN_ASPECTS["ecommerce"]}
_ASPECT_CASE = "case lang " + " ".join(f"when '{k}' then '{v}'" for k, v in _ASPECTS.items()) + f" else '{lx.DEFAULT_ASPECTS}' end"


@query(
    "prompt_aspects",
    f"select doc_id, {_fill_sql(lx.ASPECT_SYSTEM, aspects=_ASPECT_CASE)} as system_prompt, {_fill_sql(lx.ASPECT_USER, text='text')} as user_prompt from documents",
)
def aspects(spark, d):
    return P.aspect_prompts(documents(spark, d), aspects=_ASPECTS).select("doc_id", "system_prompt", "user_prompt")


# Responses are derived from the tables: each labelled document answers in one of
# the forms a model may use.
_ANSWERS = ["正面", "负面。", "This is Positive", "差评", "不知道"]
_RESP = f"""{LAB}, resp as (select doc_id, label, case (doc_id + label) % 5 {" ".join(f"when {i} then '{a}'" for i, a in enumerate(_ANSWERS))} end as response from lab),
parsed as (select *, cast(case when contains(response, '正面') then 1 when contains(response, '负面') then 0 when contains(lower(response), 'positive') or contains(response, '好') then 1
  when contains(lower(response), 'negative') or contains(response, '差') then 0 else -1 end as integer) as pred from resp)"""


def sentiment_responses(spark, d):
    i = (F.col("doc_id") + F.col("label")) % 5
    answer = F.element_at(F.array(*[F.lit(a) for a in _ANSWERS]), (i + 1).cast("int"))
    return P.parse_sentiment(labelled(spark, d).select("doc_id", "label", answer.alias("response")))


@query("resp_parse_sentiment", f"with {_RESP} select doc_id, response, pred from parsed")
def parse_sentiment(spark, d):
    return sentiment_responses(spark, d).select("doc_id", "response", "pred")


@query(
    "resp_valid_metrics",
    f"""with {_RESP}, v as (select * from parsed where pred <> -1), c as (select c, count(*) filter (label = c and pred = c) as tp, count(*) filter ((label = c) <> (pred = c)) as err, count(*) filter (label = c) as sup from v cross join (values (0), (1)) z(c) group by 1),
f as (select *, case when 2 * tp + err = 0 then 0.0::double else 2 * tp / (2 * tp + err) end as f1 from c)
select (select count(*) from parsed) as n, (select count(*) from v) as n_valid, round((select count(*) from v) / (select count(*) from parsed), 6) as valid_rate,
round(sum(tp) / sum(sup), 6) as accuracy, round(avg(f1), 6) as macro_f1, round(sum(f1 * sup) / sum(sup), 6) as weighted_f1 from f""",
)
def valid_metrics(spark, d):
    p = sentiment_responses(spark, d)
    m = M.summary(P.valid_only(p)).select(F.struct("accuracy", "macro_f1", "weighted_f1").alias("m"))
    out = P.validity(p).withColumn("_m", m.scalar()).select("n", "n_valid", "valid_rate", "_m.*")
    return rounded(out, "valid_rate", "accuracy", "macro_f1", "weighted_f1")


@query(
    "prompt_error_cases",
    f"""with {_CASES}, er as (select distinct query_id as vec_id, query_label as label, query_pred as pred from cases), ev as (select er.*, e.v from er join e using (vec_id) where vec_id in (select doc_id from documents)),
{_top_sql(q='ev', c='ev', k=3, name='near')},
j as (select n.*, q.label as ql, q.pred as qp, b.label as nl, b.pred as np, dq.text as qt, db.text as nt from near n join ev q on n.query_id = q.vec_id join ev b on n.neighbor_id = b.vec_id
  join documents dq on dq.doc_id = n.query_id join documents db on db.doc_id = n.neighbor_id)
select query_id, ({_fill_sql(lx.CASE_HEADER, text='any_value(qt)', true=_W('any_value(ql)'), pred=_W('any_value(qp)'), n='count(*)')})
  || string_agg({_fill_sql(lx.CASE_FORMAT, rank='rank', text='left(nt, 100)', true=_W('nl'), pred=_W('np'), similarity="printf('%.3f', similarity)")}, '' order by rank) || {_lit(lx.CASE_FOOTER)} as user_prompt from j group by 1""",
)
def error_case_prompts(spark, d):
    """For every error, the three nearest other errors as context."""
    cases = error_cases(spark, d).select(F.col("query_id").alias("vec_id"), F.col("query_label").alias("label"), F.col("query_pred").alias("pred")).distinct()
    wrong = cases.join(table(spark, d, "embeddings").select("vec_id", "embedding"), "vec_id")
    wrong = wrong.join(documents(spark, d).select(F.col("doc_id").alias("vec_id"), "text"), "vec_id")
    wrong = stage(wrong, "error-cases")  # queries, corpus, and twice their columns
    hits = R.topk(wrong, wrong, 3)
    cols = ["text", "label", "pred"]
    return P.case_prompts(R.with_attributes(R.with_attributes(hits, wrong, cols, side="query"), wrong, cols))


_ANALYSIS = """a as (select doc_id, case doc_id % 3 when 0 then '{"error_reason": "' || source || '", "detailed_analysis": "' || lang || '", "suggested_fix": "none"}'
  when 1 then '{"error_reason": "' || source || '"}' else 'no json from ' || source end as response from documents)"""


@query(
    "resp_parse_analysis",
    f"""with {_ANALYSIS} select doc_id, case when json_valid(response) then coalesce(response ->> '$.error_reason', '') else '未知' end as error_reason,
case when json_valid(response) then coalesce(response ->> '$.detailed_analysis', '') else response end as detailed_analysis,
case when json_valid(response) then coalesce(response ->> '$.suggested_fix', '') else '需要进一步分析' end as suggested_fix from a""",
)
def parse_analysis(spark, d):
    full = fill('{"error_reason": "<s>", "detailed_analysis": "<l>", "suggested_fix": "none"}'.replace("<s>", "{s}").replace("<l>", "{l}"), s=F.col("source"), l=F.col("domain"))
    part = fill('{"error_reason": "<s>"}'.replace("<s>", "{s}"), s=F.col("source"))
    r = F.when(F.col("doc_id") % 3 == 0, full).when(F.col("doc_id") % 3 == 1, part).otherwise(F.concat(F.lit("no json from "), "source"))
    df = documents(spark, d).select("doc_id", r.alias("response"))
    return P.parse_analysis(df).select("doc_id", "error_reason", "detailed_analysis", "suggested_fix")


# --- triplets ---------------------------------------------------------------------------

_WORD = f"coalesce(list_filter({TOKENS}, lambda x: length(x) >= 4)[1], 'none')"
_TRIP = f"""w as (select doc_id, source, lang, {_WORD} as word, case doc_id % 3 when 0 then '正面' when 1 then '负面' else '中性' end as pol from documents),
t as (select doc_id, unnest(case doc_id % 4 when 0 then [(source, word, pol), (lang, source, '正面')] when 1 then [(source, word, pol)] else [] end) as t from w),
tr as (select doc_id, t[1] as aspect, t[2] as opinion, t[3] as sentiment from t)"""


def first_word():
    """The first token of four characters or more."""
    found = F.regexp_extract(F.lower("text"), r"[\p{L}\p{N}_]{4,}", 0)
    return F.when(found == "", "none").otherwise(found)


def triplet_responses(spark, d):
    """0: fenced array of two, 1: array whose second item lacks a sentiment,
    2: text that is not JSON, 3: a single JSON object."""
    word = first_word()
    base = documents(spark, d).select(
        "doc_id", "source", "domain", word.alias("word"),
        F.element_at(F.array(F.lit("正面"), F.lit("负面"), F.lit("中性")), (F.col("doc_id") % 3 + 1).cast("int")).alias("pol"),
    )
    one = F.concat(F.lit('{"aspect": "'), "source", F.lit('", "opinion": "'), "word", F.lit('", "sentiment": "'), "pol", F.lit('"}'))
    two = F.concat(F.lit('{"aspect": "'), "domain", F.lit('", "opinion": "'), "source", F.lit('", "sentiment": "正面"}'))
    k = F.col("doc_id") % 4
    response = (
        F.when(k == 0, F.concat(F.lit("```json\n["), one, F.lit(", "), two, F.lit("]\n```")))
        .when(k == 1, F.concat(F.lit("["), one, F.lit(', {"aspect": "'), "domain", F.lit('"}]')))
        .when(k == 2, F.concat(F.lit("no triplets in "), "source"))
        .otherwise(one)
    )
    return T.extract(base.select("doc_id", response.alias("response")))


@query("abs_extract", f"with {_TRIP} select d.doc_id, cast(count(tr.doc_id) as integer) as n_triplets from documents d left join tr using (doc_id) group by 1")
def extract(spark, d):
    return triplet_responses(spark, d).select("doc_id", "n_triplets")


@query("abs_explode", f"with {_TRIP} select d.doc_id, coalesce(aspect, '') as aspect, coalesce(opinion, '') as opinion, coalesce(sentiment, '') as sentiment from documents d left join tr using (doc_id)")
def explode(spark, d):
    return T.explode_triplets(triplet_responses(spark, d), ["doc_id"])


@query("abs_statistics", f"with {_TRIP} select count(*) as total_triplets, count(distinct aspect) as unique_aspects from tr")
def statistics(spark, d):
    return T.statistics(triplet_responses(spark, d))


@query("abs_top_aspects", f"with {_TRIP} select aspect, count(*) as n from tr group by 1 order by n desc, aspect limit 10")
def top_aspects(spark, d):
    return T.top_aspects(triplet_responses(spark, d))


@query("abs_sentiment_shares", f"with {_TRIP} select sentiment, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from tr group by 1")
def shares(spark, d):
    return rounded(T.sentiment_shares(triplet_responses(spark, d)), "share")


@query(
    "abs_crosstab",
    f"""with {_TRIP}, top as (select aspect from tr group by 1 order by count(*) desc, aspect limit 5)
select aspect, count(*) filter (sentiment = '正面') as pos, count(*) filter (sentiment = '负面') as neg, count(*) filter (sentiment = '中性') as neu from tr semi join top using (aspect) group by 1""",
)
def crosstab(spark, d):
    t = T.aspect_crosstab(triplet_responses(spark, d), ["正面", "负面", "中性"])
    return t.select("aspect", F.col("正面").alias("pos"), F.col("负面").alias("neg"), F.col("中性").alias("neu"))


_GOLD = f"""w as (select doc_id, source, lang, {_WORD} as word from documents),
g as (select doc_id, case doc_id % 4 when 0 then [source || ',' || word || ',POS', lang || ',' || source || ',NEG'] when 1 then [source || ',' || word || ',POS'] when 2 then [source || ',' || word || ',NEG'] else [] end as gold,
  case doc_id % 3 when 0 then [source || ',' || word || ',POS'] when 1 then [source || ',' || word || ',POS', lang || ',' || word || ',NEU'] else [] end as pred from w),
x as (select doc_id, len(list_intersect(pred, gold)) as tp, len(pred) - len(list_intersect(pred, gold)) as fp, len(gold) - len(list_intersect(pred, gold)) as fn from g),
sc as (select *, case when tp + fp = 0 then 0.0::double else tp / (tp + fp) end as precision, case when tp + fn = 0 then 0.0::double else tp / (tp + fn) end as recall,
  case when 2 * tp + fp + fn = 0 then 0.0::double else 2 * tp / (2 * tp + fp + fn) end as f1 from x)"""


def scored_triplets(spark, d):
    word = first_word()
    w = documents(spark, d).select("doc_id", "source", "domain", word.alias("word"))
    tri = lambda a, o, p: F.concat_ws(",", a, o, F.lit(p))
    lit = lambda a, o, p: F.concat(F.lit("('"), a, F.lit("', '"), o, F.lit(f"', '{p}')"))
    k = F.col("doc_id")
    gold_ = (
        F.when(k % 4 == 0, F.concat_ws(";", tri("source", "word", "POS"), tri("domain", "source", "NEG")))
        .when(k % 4 == 1, F.concat(F.lit("["), lit(F.col("source"), F.col("word"), "POS"), F.lit("]")))
        .when(k % 4 == 2, tri("source", "word", "NEG"))
    )
    pred = F.when(k % 3 == 0, tri("source", "word", "POS")).when(
        k % 3 == 1, F.concat_ws(";", tri("source", "word", "POS"), tri("domain", "word", "NEU"), tri("source", "word", "POS"))
    ).otherwise("")
    return T.triplet_scores(w.select("doc_id", pred.alias("pred_triplets"), gold_.alias("gold_triplets")))


@query(
    "abs_triplet_scores",
    f"with {_GOLD} select doc_id, cast(tp as integer) as tp, cast(fp as integer) as fp, cast(fn as integer) as fn, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1 from sc",
)
def triplet_scores(spark, d):
    return rounded(scored_triplets(spark, d), "precision", "recall", "f1")


@query(
    "abs_triplet_summary",
    f"with {_GOLD} select count(*) as n, round(avg(precision), 6) as precision, round(avg(recall), 6) as recall, round(avg(f1), 6) as f1, round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) as micro_f1 from sc",
)
def triplet_summary(spark, d):
    return rounded(T.triplet_summary(scored_triplets(spark, d)), "precision", "recall", "f1", "micro_f1")
