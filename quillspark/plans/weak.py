"""Queries: keyword labels, labelling rules, votes."""

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import contains_any, presence_count
from ..operators import labeling as L, metrics as M
from .base import LAB, any_word, count_words, documents, h, hint, labelled, query, rounded, table

# Word lists for the synthetic test texts. They only bind the operators to
# these tables; the defaults of the operators are the Chinese review lexicons.
POS = ["that", "with", "from", "nicht", "elle", "para"]
NEG = ["worthless", "trash", "idiot", "$$$"]
POS2, NEG2 = ["tion", "lich"], ["&&&", "###"]
POS3, NEG3 = ["thing", "ment"], ["***", "%%%"]
NEGATORS, NEGATED = ["in", "un", "re"], ["thing", "sche", "ment"]
SHORT_POS, SHORT_NEG = ["ther", "ent"], ["$$$", "a"]
EXCL_NEG = ["IDIOT", "TRASH", "THE!!"]
COMP_POS, COMP_NEG = ["ering", "erlich"], ["worthless", "idiot"]
MARK_POS, MARK_NEG = ["thble", "ción"], ["|", "trash"]
REC_POS, REC_NEG = ["antion", "éelle"], ["attion", "trash"]

RULES = {
    "basic_keywords": R.keyword_rule(POS, NEG, 2),
    "service_keywords": R.keyword_rule(POS2, NEG2, 1),
    "environment_keywords": R.keyword_rule(POS3, NEG3, 1),
    "negation": R.negation_rule(NEGATORS, NEGATED),
    "length": R.short_text_rule(SHORT_POS, SHORT_NEG, 400),
    "exclamation": R.exclamation_rule(EXCL_NEG),
    "comparison": R.first_match_rule(COMP_POS, COMP_NEG),
    "emoji": R.first_match_rule(MARK_POS, MARK_NEG),
    "recommend": R.first_match_rule(REC_POS, REC_NEG),
}
NAMES = list(RULES)


def _kw(pos, neg, t):
    p, n = count_words(pos), count_words(neg)
    return f"case when {p} >= {t} and {p} > {n} then 1 when {n} >= {t} and {n} > {p} then 0 else -1 end"


def _first(pos, neg):
    return f"case when {any_word(pos)} then 1 when {any_word(neg)} then 0 else -1 end"


_NEGATED = " or ".join(f"contains(text, '{a}{s}{b}')" for a in NEGATORS for b in NEGATED for s in ("", " "))
_MARKS = "(length(text) - length(replace(text, '!', '')))"
RULE_SQL = {
    "basic_keywords": _kw(POS, NEG, 2),
    "service_keywords": _kw(POS2, NEG2, 1),
    "environment_keywords": _kw(POS3, NEG3, 1),
    "negation": f"case when {_NEGATED} then 0 else -1 end",
    "length": f"case when length(text) <= 400 then {_first(SHORT_POS, SHORT_NEG)} else -1 end",
    "exclamation": f"case when {_MARKS} < 2 then -1 when {any_word(EXCL_NEG)} then 0 else 1 end",
    "comparison": _first(COMP_POS, COMP_NEG),
    "emoji": _first(MARK_POS, MARK_NEG),
    "recommend": _first(REC_POS, REC_NEG),
}
VOTES_SQL = ", ".join(f"cast({s} as integer) as vote_{n}" for n, s in RULE_SQL.items())


def _sum(cond, weights=None):
    return " + ".join(
        f"(case when vote_{n} {cond} then {weights[n] if weights else '1.0::double'} else 0.0::double end)" for n in NAMES
    )


VOTED_SQL = f"""v as (select doc_id, domain, label, {VOTES_SQL} from lab),
st as (select {", ".join(f"coalesce(avg(case when vote_{n} <> -1 then cast(vote_{n} = label as integer) end), 0.5) as w_{n}" for n in NAMES)} from v),
s as (select v.*, {_sum("= 1", {n: f"w_{n}" for n in NAMES})} as pw, {_sum("= 0", {n: f"w_{n}" for n in NAMES})} as nw from v cross join st),
voted as (select *, cast(pw > nw as integer) as weak_label,
  case when pw + nw = 0 then 0.5 else greatest(pw, nw) / (pw + nw) end as confidence, (pw + nw = 0) as all_abstain from s)"""


def rule_votes(spark, d):
    return L.apply_rules(labelled(spark, d), RULES)


def voted(spark, d):
    v = rule_votes(spark, d)
    stats = L.rule_statistics(v, NAMES)
    return L.vote(v, NAMES, L.weights_by_accuracy(stats, NAMES))


def all_votes(spark, d):
    return L.apply_rules(documents(spark, d), RULES)


for _n in NAMES:
    # One query per rule over every document.
    query(f"lf_{_n}", f"select doc_id, cast({RULE_SQL[_n]} as integer) as vote from documents")(
        lambda spark, d, n=_n: documents(spark, d).select("doc_id", RULES[n](F.col("text")).alias("vote"))
    )


@query("lbl_vote_matrix", f"select doc_id, {VOTES_SQL} from documents")
def vote_matrix(spark, d):
    return all_votes(spark, d).select("doc_id", *L.vote_columns(NAMES))


@query(
    "lbl_rule_statistics",
    f"with {LAB}, v as (select label, {VOTES_SQL} from lab) "
    + " union all ".join(
        f"select {i} as rule_no, '{n}' as rule, round(avg(cast(vote_{n} <> -1 as integer)), 6) as coverage, "
        f"round(coalesce(avg(case when vote_{n} <> -1 then cast(vote_{n} = label as integer) end), 0.5), 6) as accuracy, "
        f"count(*) filter (vote_{n} = 1) as n_pos, count(*) filter (vote_{n} = 0) as n_neg from v"
        for i, n in enumerate(NAMES)
    ),
)
def rule_stats(spark, d):
    return rounded(L.rule_statistics(rule_votes(spark, d), NAMES), "coverage", "accuracy")


@query(
    "lbl_weighted_vote",
    f"with {LAB}, {VOTED_SQL} select doc_id, label, weak_label, round(confidence, 6) as confidence, all_abstain from voted",
)
def weighted(spark, d):
    return rounded(voted(spark, d).select("doc_id", "label", "weak_label", "confidence", "all_abstain"), "confidence")


@query(
    "lbl_equal_vote",
    f"with v as (select doc_id, {VOTES_SQL} from documents), s as (select doc_id, {_sum('= 1')} as pw, {_sum('= 0')} as nw from v) "
    "select doc_id, cast(pw > nw as integer) as weak_label, "
    "round(case when pw + nw = 0 then 0.5 else greatest(pw, nw) / (pw + nw) end, 6) as confidence, (pw + nw = 0) as all_abstain from s",
)
def equal(spark, d):
    return rounded(
        L.vote(all_votes(spark, d), NAMES).select("doc_id", "weak_label", "confidence", "all_abstain"), "confidence"
    )


@query("lbl_weak_distribution", f"with {LAB}, {VOTED_SQL} select weak_label, count(*) as n from voted group by 1")
def weak_distribution(spark, d):
    return L.label_distribution(voted(spark, d))


@query(
    "lbl_rule_overlap",
    f"with v as (select {VOTES_SQL} from documents) "
    + " union all ".join(
        f"select '{a}' as rule_a, '{b}' as rule_b, round(avg(cast(vote_{a} <> -1 and vote_{b} <> -1 as integer)), 6) as overlap, "
        f"round(avg(cast(vote_{a} <> -1 and vote_{b} <> -1 and vote_{a} <> vote_{b} as integer)), 6) as conflict from v"
        for i, a in enumerate(NAMES) for b in NAMES[i + 1 :]
    ),
)
def overlap(spark, d):
    return rounded(L.rule_overlap(all_votes(spark, d), NAMES), "overlap", "conflict")


@query(
    "weak_supervision_quality",
    f"""with {LAB}, {VOTED_SQL},
c as (select c as class, count(*) filter (label = c and weak_label = c) as tp, count(*) filter (label <> c and weak_label = c) as fp,
  count(*) filter (label = c and weak_label <> c) as fn, count(*) filter (label = c) as support
  from voted cross join (values (0), (1)) t(c) group by 1),
f as (select *, case when tp + fp = 0 then 0.0 else tp / (tp + fp) end as p, case when tp + fn = 0 then 0.0 else tp / (tp + fn) end as r,
  case when 2 * tp + fp + fn = 0 then 0.0 else 2.0 * tp / (2 * tp + fp + fn) end as f1 from c)
select cast(class as varchar) as class, round(p, 6) as precision, round(r, 6) as recall, round(f1, 6) as f1, support from f
union all select 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), cast(sum(support) as bigint) from f
union all select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), cast(sum(support) as bigint) from f
union all select 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from f""",
)
def weak_quality(spark, d):
    """How good is the voted weak label?"""
    return rounded(M.report(voted(spark, d), pred="weak_label"), "precision", "recall", "f1")


# --- keyword and dictionary labels ---------------------------------------------------

_P, _N = count_words(POS + POS3), count_words(NEG + NEG3)


@query("lbl_keyword", f"select doc_id, cast({_P} > {_N} as integer) as label from documents")
def keyword(spark, d):
    return documents(spark, d).select("doc_id", R.keyword_label(F.col("text"), POS + POS3, NEG + NEG3).alias("label"))


@query(
    "lbl_keyword_random_tie",
    f"select doc_id, cast(case when {_P} > {_N} then 1 when {_P} = {_N} then {hint(h())} % 2 else 0 end as integer) as label from documents",
)
def keyword_tie(spark, d):
    return documents(spark, d).select(
        "doc_id", R.keyword_label(F.col("text"), POS + POS3, NEG + NEG3, tie_id=F.col("doc_id")).alias("label")
    )


@query("lbl_keyword_second_lexicon", f"select doc_id, cast({count_words(POS2)} > {count_words(NEG2)} as integer) as label from documents")
def keyword_second(spark, d):
    return documents(spark, d).select("doc_id", R.keyword_label(F.col("text"), POS2, NEG2).alias("label"))


_SCORE_POS, _SCORE_NEG = count_words(POS), count_words(NEG)
_SCORE = f"(case when trim(text) = '' then 0.5 else ({_SCORE_POS} + 1) / ({_SCORE_POS} + {_SCORE_NEG} + 2) end)"


@query(
    "lbl_score_threshold",
    f"select doc_id, round({_SCORE}, 6) as score, cast({_SCORE} >= 0.5 as integer) as label_ge, cast({_SCORE} > 0.5 as integer) as label_gt from documents",
)
def score_threshold(spark, d):
    s = documents(spark, d).select("doc_id", R.lexicon_score(F.col("text"), POS, NEG).alias("score"))
    return rounded(
        s.select("doc_id", "score", R.threshold_label(F.col("score")).alias("label_ge"), R.threshold_label(F.col("score"), inclusive=False).alias("label_gt")),
        "score",
    )


_DICT = _first(REC_POS, NEG)


@query("lbl_dictionary", f"select doc_id, cast({_DICT} as integer) as label from documents")
def dictionary(spark, d):
    return documents(spark, d).select("doc_id", R.first_match_rule(REC_POS, NEG)(F.col("text")).alias("label"))


@query(
    "lbl_rule_then_score",
    f"""with s as (select doc_id, {_DICT} as r, {_SCORE} as score from documents)
select doc_id, cast(case when r <> -1 then r when score >= 0.8 then 1 when score <= 1.0::double - 0.8::double then 0 else -1 end as integer) as weak_label,
  case when r <> -1 then 'rule' when score >= 0.8 then 'model_high' when score <= 1.0::double - 0.8::double then 'model_low' else 'abstain' end as label_source from s""",
)
def rule_then_score(spark, d):
    df = documents(spark, d).withColumn("model_score", R.lexicon_score(F.col("text"), POS, NEG))
    out = L.combine_rule_and_score(df, R.first_match_rule(REC_POS, NEG)(F.col("text")))
    return out.select("doc_id", "weak_label", "label_source")


POLICY = {"trash": 0, "idiot": 0, "thing": 1}
_POLICY = "case " + " ".join(f"when contains(text, '{w}') then {v}" for w, v in POLICY.items()) + " else -1 end"


@query(
    "lbl_policy",
    f"""with s as (select doc_id, {_POLICY} as r, {_SCORE} as score from documents)
select doc_id, cast(case when r <> -1 then r when score >= 0.7 then 1 when score <= 1.0::double - 0.7::double then 0 else -1 end as integer) as weak_label,
  case when r <> -1 then 'rule' when score >= 0.7 then 'model_high' when score <= 1.0::double - 0.7::double then 'model_low' else 'abstain' end as label_source from s""",
)
def policy(spark, d):
    df = documents(spark, d).withColumn("model_score", R.lexicon_score(F.col("text"), POS, NEG))
    out = L.combine_rule_and_score(df, R.policy_label(F.col("text"), POLICY), threshold=0.7)
    return out.select("doc_id", "weak_label", "label_source")


@query(
    "lbl_compare_sources",
    f"""with {LAB}, {VOTED_SQL}, k as (select label, 'vote' as source, weak_label as pred from voted
  union all select label, 'keyword', cast({_P} > {_N} as integer) from lab union all select label, 'score', cast({_SCORE} >= 0.5 as integer) from lab),
c as (select source, c, count(*) filter (label = c and pred = c) as tp, count(*) filter ((label = c) <> (pred = c)) as err
  from k cross join (values (0), (1)) t(c) group by 1, 2),
f as (select source, avg(case when 2 * tp + err = 0 then 0.0 else 2.0 * tp / (2 * tp + err) end) as macro_f1 from c where tp + err > 0 group by 1)
select source, round(macro_f1, 6) as macro_f1, round((macro_f1 - (select macro_f1 from f where source = 'score')) * 100, 6) as gain from f""",
)
def compare(spark, d):
    votes = voted(spark, d).select("label", F.lit("vote").alias("source"), F.col("weak_label").alias("pred"))
    lab = labelled(spark, d)
    kw = lab.select("label", F.lit("keyword").alias("source"), R.keyword_label(F.col("text"), POS + POS3, NEG + NEG3).alias("pred"))
    sc = lab.select("label", F.lit("score").alias("source"), R.threshold_label(R.lexicon_score(F.col("text"), POS, NEG)).alias("pred"))
    m = M.summary(votes.unionByName(kw).unionByName(sc), ["source"]).select("source", "macro_f1")
    return rounded(L.compare_sources(m, "score"), "macro_f1", "gain")


@query(
    "lbl_route",
    f"select doc_id, round({_SCORE}, 6) as score, case when abs({_SCORE} - 0.5) >= 0.3 then 'auto' else 'review' end as route from documents",
)
def route(spark, d):
    s = documents(spark, d).select("doc_id", R.lexicon_score(F.col("text"), POS, NEG).alias("score"))
    return rounded(L.route(s), "score")
