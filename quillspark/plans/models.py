"""Queries: term features, Naive Bayes, cross-validation, transfer."""

from pyspark.sql import functions as F

from ..operators import balance as B, bayes as NB, features as FE, metrics as M, splits as SP
from ..session import stage
from .base import LAB, TOKENS, documents, h, labelled, query, rank, rounded, table

VOCAB = 5000
_R = f"r as (select *, {rank('label')} as rk, count(*) over (partition by label) as n from lab)"
_TEST = "case when n >= 2 then least(greatest(floor(0.2::double * n + 0.5::double), 1), n - 1) else 0 end"
_SPLIT = f"{LAB}, {_R}, sp as (select *, case when rk <= {_TEST} then 'test' else 'train' end as split from r)"
_TC = f"tok as (select doc_id, unnest({TOKENS}) as term from documents), tc as (select doc_id, term, count(*) as tf from tok where length(term) >= 2 group by 1, 2)"


@query("fea_term_counts", f"with {_TC} select * from tc")
def term_counts(spark, d):
    return FE.term_counts(documents(spark, d))


@query(
    "fea_vocabulary_cap",
    f"with {_TC} select term, count(*) as df, cast(sum(tf) as bigint) as cnt from tc group by 1 order by cnt desc, term limit 3000",
)
def vocabulary(spark, d):
    return FE.vocabulary(FE.term_counts(documents(spark, d)), 3000)


@query(
    "fea_pruned_vocabulary",
    f"with {_TC} select term, count(*) as df, cast(sum(tf) as bigint) as cnt from tc group by 1 having count(*) >= 2 and count(*) <= 0.5 * (select count(*) from documents)",
)
def pruned(spark, d):
    docs = documents(spark, d)
    n = docs.agg(F.count("*").alias("n")).scalar()
    return FE.vocabulary(FE.term_counts(docs), min_df=2, max_df_share=0.5, n_docs=n)


@query(
    "fea_bag_of_words",
    f"""with {_TC}, v as (select term from tc group by 1 having count(*) >= 2 and count(*) <= 0.5 * (select count(*) from documents))
select doc_id, count(*) as n_terms, cast(sum(tf) as bigint) as n_tokens, max(tf) as top_tf from tc semi join v using (term) group by 1""",
)
def bag(spark, d):
    docs = documents(spark, d)
    tc = stage(FE.term_counts(docs), "term-counts")  # read twice, cut once
    keep = FE.vocabulary(tc, min_df=2, max_df_share=0.5, n_docs=docs.agg(F.count("*").alias("n")).scalar()).select("term")
    keep = stage(keep, "kept-terms")
    keep = FE.bounded(keep, keep.count())
    return tc.join(keep, "term", "left_semi").groupBy("doc_id").agg(
        F.count("*").alias("n_terms"), F.sum("tf").alias("n_tokens"), F.max("tf").alias("top_tf")
    )


def _tfidf_sql(fit_tc, apply_tc, n_docs, cap, name="w"):
    return f"""{name}_v as (select term, count(*) as df, sum(tf) as cnt from {fit_tc} group by 1 order by cnt desc, term limit {cap}),
{name}_x as (select doc_id, term, tf, tf * (ln((1 + {n_docs})::double / (1 + df)) + 1) as x from {apply_tc} join {name}_v using (term)),
{name} as (select doc_id, term, tf, x / sqrt(sum(x * x) over (partition by doc_id)) as tfidf from {name}_x)"""


@query("fea_tfidf", f"with {_TC}, {_tfidf_sql('tc', 'tc', '(select count(*) from documents)', VOCAB)} select doc_id, term, tf, round(tfidf, 6) as tfidf from w")
def tfidf(spark, d):
    docs = documents(spark, d)
    tc = FE.term_counts(docs)
    idf = FE.idf_table(tc, docs.agg(F.count("*").alias("n")).scalar(), VOCAB)
    return rounded(FE.tfidf(tc, idf, max_features=VOCAB), "tfidf")


@query(
    "fea_tfidf_fit_transform",
    f"""with {_SPLIT}, tok as (select doc_id, split, unnest({TOKENS}) as term from sp), tcs as (select doc_id, split, term, count(*) as tf from tok where length(term) >= 2 group by 1, 2, 3),
ft as (select * from tcs where split = 'train'), ap as (select * from tcs where split = 'test'),
{_tfidf_sql('ft', 'ap', "(select count(*) from sp where split = 'train')", 3000)} select doc_id, term, tf, round(tfidf, 6) as tfidf from w""",
)
def fit_transform(spark, d):
    parts = SP.stratified_holdout(labelled(spark, d))
    train, test = parts.where("split = 'train'"), parts.where("split = 'test'")
    idf = FE.idf_table(FE.term_counts(train), train.agg(F.count("*").alias("n")).scalar(), 3000)
    return rounded(FE.tfidf(FE.term_counts(test), idf, max_features=3000), "tfidf")


@query(
    "fea_l2_normalize",
    "select vec_id, round(list_sum(list_transform(v, lambda x: x * x)), 6) as norm2, round(list_sum(v), 6) as total from "
    "(select vec_id, list_transform(embedding, lambda x: x::double / sqrt(list_sum(list_transform(embedding, lambda y: y::double * y::double)))) as v from embeddings)",
)
def l2(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", FE.l2_normalize(F.col("embedding")).alias("v"))
    total = lambda f: F.aggregate("v", F.lit(0.0), lambda a, x: a + f(x))
    return rounded(e.select("vec_id", total(lambda x: x * x).alias("norm2"), total(lambda x: x).alias("total")), "norm2", "total")


# --- Naive Bayes -----------------------------------------------------------------------

_BAL = """m as (select max(n) as mx, min(n) as mn from (select count(*) as n from sp where split = 'train' group by label)),
tr as (select *, row_number() over (partition by label order by md5(concat(cast(doc_id as varchar), '-42')), doc_id) as trk, count(*) over (partition by label) as tn from sp where split = 'train'),
trw as (select tr.*, case when mn < greatest(5.0, mx * 0.2::double) and mx > tn then (mx - trk) // tn + 1 else 1 end as copies from tr cross join m)"""


def nb_sql(train="trw", weight="copies", test="te", vocab=VOCAB, name="nb", keys="", alpha="1.0"):
    """Counts, smoothed log-probabilities and scores; ``keys`` adds models."""
    k = f"{keys}, " if keys else ""
    part = f"partition by {keys}" if keys else ""
    on = f"using ({k}term)"
    return f"""{name}_t as (select {k}label, {weight} as w, unnest({TOKENS}) as term from {train}),
{name}_c as (select {k}term, cast(sum(case when label = 0 then w else 0 end) as bigint) as c0, cast(sum(case when label = 1 then w else 0 end) as bigint) as c1 from {name}_t where length(term) >= 2 group by {k}term),
{name}_v as (select * from (select *, row_number() over ({part} order by c0 + c1 desc, term) as vr from {name}_c where c0 + c1 > 0) where vr <= {vocab}),
{name}_m as (select {k}term, ln((c0 + {alpha}::double) / (sum(c0) over ({part}) + {alpha}::double * count(*) over ({part}))) as lp_0, ln((c1 + {alpha}::double) / (sum(c1) over ({part}) + {alpha}::double * count(*) over ({part}))) as lp_1 from {name}_v),
{name}_p as (select {k}case when sum(case when label = 0 then {weight} end) > 0 then ln(sum(case when label = 0 then {weight} end)::double / sum({weight})) end as p0,
  case when sum(case when label = 1 then {weight} end) > 0 then ln(sum(case when label = 1 then {weight} end)::double / sum({weight})) end as p1 from {train} {('group by ' + keys) if keys else ''}),
{name}_x as (select {k}doc_id, unnest({TOKENS}) as term from {test}),
{name}_s as (select {k}doc_id, sum(cast(round(lp_0 * 1e9::double) as bigint)) / 1e9::double as s0, sum(cast(round(lp_1 * 1e9::double) as bigint)) / 1e9::double as s1 from {name}_x join {name}_m {on} group by {k}doc_id),
{name}_r as (select te.*, p0 + coalesce(s0, 0) as s0, p1 + coalesce(s1, 0) as s1 from {test} te left join {name}_s using ({k}doc_id) {'join ' + name + '_p using (' + keys + ')' if keys else 'cross join ' + name + '_p'}),
{name} as (select *, cast(case when s0 is null then 1 when s1 is null then 0 when s1 > s0 then 1 else 0 end as integer) as pred,
  coalesce(exp(s1 - case when s0 is null or s1 > s0 then s1 else s0 end), 0) / (coalesce(exp(s0 - case when s0 is null or s1 > s0 then s1 else s0 end), 0) + coalesce(exp(s1 - case when s0 is null or s1 > s0 then s1 else s0 end), 0)) as prob from {name}_r)"""


_NB = f"{_SPLIT}, {_BAL}, te as (select doc_id, label, domain, source from sp where split = 'test'), tex as (select doc_id, label, domain, source, text from sp where split = 'test')"
_NB_FULL = f"{_NB}, {nb_sql(test='tex')}"


def nb_fitted(spark, d):
    parts = SP.stratified_holdout(labelled(spark, d))
    train = B.copies_to_majority(parts.where("split = 'train'"))
    w = {"m": F.col("copies")}
    return parts.where("split = 'test'"), NB.fit(train, w, max_features=VOCAB), NB.priors(train, w)


def nb_predictions(spark, d):
    test, model, prior = nb_fitted(spark, d)
    scored = NB.score(test, model, prior, ["m"], keep=["label", "domain", "source"])
    pred, prob = NB.predict(scored, "m")
    return scored.select("doc_id", "label", "domain", "source", "s_m_0", "s_m_1", pred.cast("int").alias("pred"), prob.alias("prob"))


@query("mod_nb_scores", f"with {_NB_FULL} select doc_id, label, round(s0, 6) as s0, round(s1, 6) as s1, pred from nb")
def nb_scores(spark, d):
    p = nb_predictions(spark, d)
    return rounded(p.select("doc_id", "label", F.col("s_m_0").alias("s0"), F.col("s_m_1").alias("s1"), "pred"), "s0", "s1")


@query(
    "mod_nb_top_features",
    f"""with {_NB_FULL}, l as (select 0 as class, term, lp_0 as logprob from nb_m union all select 1, term, lp_1 from nb_m),
t as (select *, cast(row_number() over (partition by class order by round(logprob, 9) desc, term) as integer) as rank from l)
select class, rank, term, round(logprob, 6) as logprob from t where rank <= 10""",
)
def top_features(spark, d):
    _, model, _ = nb_fitted(spark, d)
    return rounded(NB.top_features(model).select("class", "rank", "term", "logprob"), "logprob")


# --- calibration of the margins, held out by parity of the id -----------------------------

_MARGIN = f"{_NB_FULL}, mg as (select doc_id, label, s1 - s0 as m from nb), va as (select * from mg where doc_id % 2 = 0), ap as (select * from mg where doc_id % 2 = 1)"


def _platt_sql(rounds=15):
    """Newton rounds, each a pair of tables: the step, then the best of its lengths."""
    out = f"""{_MARGIN}, pc as (select count(*) filter (label = 1) as p, count(*) filter (label <> 1) as n, case when max(abs(m)) > 0 then max(abs(m)) else 1 end as u from va),
pt as (select m / u as x, case when label = 1 then (p + 1.0::double) / (p + 2.0::double) else 1.0::double / (n + 2.0::double) end as t from va, pc),
w0 as (select 0.0::double as a, ln((p + 1.0::double) / (n + 1.0::double)) as b from pc)"""
    for i in range(rounds):
        out += f""",
g{i} as (select a, b, sum((q - t) * x) as ga, sum(q - t) as gb, sum(q * (1 - q) * x * x) + 1e-12 as aa, sum(q * (1 - q) * x) as ab, sum(q * (1 - q)) + 1e-12 as bb
  from (select *, 1 / (1 + exp(-(a * x + b))) as q from pt, w{i}) group by a, b),
c{i} as (select a - s * (bb * ga - ab * gb) / (aa * bb - ab * ab) as a, b - s * (aa * gb - ab * ga) / (aa * bb - ab * ab) as b, s from g{i}, (values (1.0::double), (0.5), (0.25), (0.125), (0.0625), (0.0)) l(s)),
w{i + 1} as materialized (select a, b from (select a, b, s, sum(greatest(a * x + b, 0) - (a * x + b) * t + ln(1 + exp(-abs(a * x + b)))) as loss from c{i}, pt group by a, b, s) order by round(loss, 10), s desc limit 1)"""
    return out + f" select doc_id, label, round(1 / (1 + exp(-(a * m / u + b))), 6) as prob from ap, pc, w{rounds}"


def _halves(spark, d):
    from ..session import stage

    m = nb_predictions(spark, d).select("doc_id", "label", (F.col("s_m_1") - F.col("s_m_0")).alias("margin"))
    m = stage(m, "nb-margins")
    return m.where("doc_id % 2 = 0"), m.where("doc_id % 2 = 1")


@query("cal_platt_nb", f"with {_platt_sql()}")
def platt_nb(spark, d):
    """Platt scaling of Naive Bayes margins."""
    from ..operators import calibrate as C

    valid, rest = _halves(spark, d)
    return rounded(C.platt_apply(C.platt_fit(valid), rest).select("doc_id", "label", "prob"), "prob")


@query(
    "cal_temperature_nb",
    f"""with {_MARGIN}, gr as (select round(0.1 * i, 1)::double as t from range(1, 101) x(i)),
nl as (select t, avg(case when z > 0 then ln(1 + exp(-z)) else ln(1 + exp(z)) - z end) as nll from (select t, case when label = 1 then m else -m end / t as z from va, gr) group by t),
bt as (select t from nl order by round(nll, 10), t limit 1) select doc_id, label, round(1 / (1 + exp(-m / t)), 6) as prob from ap, bt""",
)
def temperature_nb(spark, d):
    """Temperature scaling of Naive Bayes margins."""
    from ..operators import calibrate as C

    valid, rest = _halves(spark, d)
    return rounded(C.temperature_apply(rest, C.temperature_fit(valid)).select("doc_id", "label", "prob"), "prob")


@query(
    "cal_isotonic_nb",
    f"""with {_MARGIN}, points as (select round(m, 6) as x, count(*) as n, sum(cast(label = 1 as bigint)) as s from va where m is not null group by 1),
totals as (select x, row_number() over (order by x) as i, sum(n) over (order by x) as cn, sum(s) over (order by x) as cs, sum(n) over (order by x) - n as bn, sum(s) over (order by x) - s as bs from points),
spans as (select a.i as a, b.i as b, min((b.cs - a.bs)::double / (b.cn - a.bn)::double) over (partition by a.i order by b.i desc) as least from totals a join totals b on a.i <= b.i),
fitted as (select b as i, max(least) as y from spans group by b), iso as (select totals.x, y from fitted join totals using (i)),
asked as (select doc_id, label, round(m, 6) as x from ap),
below as (select t.doc_id, max(iso.x) as x0, arg_max(iso.y, iso.x) as y0 from asked t left join iso on iso.x <= t.x group by 1),
above as (select t.doc_id, min(iso.x) as x1, arg_min(iso.y, iso.x) as y1 from asked t left join iso on iso.x >= t.x group by 1)
select doc_id, label, round(case when x0 is null then y1 when x1 is null then y0 when x0 = x1 then y0 else y0 + (y1 - y0) / (x1 - x0) * (x - x0) end, 6) as prob
from asked t join below using (doc_id) join above using (doc_id)""",
)
def isotonic_nb(spark, d):
    """Isotonic calibration of Naive Bayes margins, which the SQL derives from the max-min formula."""
    from ..operators import isotonic as I

    valid, rest = (rounded(x, "margin") for x in _halves(spark, d))
    return rounded(I.isotonic_probabilities(rest, I.isotonic_blocks(valid)).select("doc_id", "label", "prob"), "prob")


@query("mod_nb_batch_scoring", f"with {_SPLIT}, {_BAL}, te as (select doc_id from documents), tex as (select doc_id, text from documents), {nb_sql(test='tex')} select doc_id, round(prob, 6) as prob, cast(prob > 0.5 as integer) as label from nb")
def batch_scoring(spark, d):
    """Every document, labelled or not, scored by the fitted model."""
    _, model, prior = nb_fitted(spark, d)
    scored = NB.score(documents(spark, d), model, prior, ["m"])
    _, prob = NB.predict(scored, "m")
    return rounded(scored.select("doc_id", prob.alias("prob"), (prob > 0.5).cast("int").alias("label")), "prob")


@query(
    "mod_fold_guard",
    f"""with {LAB}, c as (select domain, label, count(*) as n from lab group by 1, 2)
select domain, count(*) as n_classes, min(n) as smallest, case when min(n) < 5 then 'holdout' else 'folds' end as plan from c group by 1""",
)
def fold_guard(spark, d):
    from ..operators.linear import fold_plan

    return fold_plan(labelled(spark, d), keys=["domain"])


_CV = f"""{LAB}, {_R}, fo as (select doc_id, label, domain, text, cast((rk - 1) % 5 as integer) as fold from r),
tr0 as (select fo.*, h.held from fo join (select unnest(range(0, 5)) as held) h on fo.fold <> h.held),
tr as (select *, row_number() over (partition by held, label order by {h()}, doc_id) as trk, count(*) over (partition by held, label) as tn from tr0),
m as (select held, max(n) as mx, min(n) as mn from (select held, label, count(*) as n from tr0 group by 1, 2) group by 1),
trw as (select tr.*, case when mn < greatest(5.0, mx * 0.2::double) and mx > tn then (mx - trk) // tn + 1 else 1 end as copies from tr join m using (held)),
tex as (select *, cast(fold as bigint) as held from fo), {nb_sql(test='tex', keys='held', vocab=20000)}"""


def cv_predictions(spark, d):
    return NB.cross_validate(labelled(spark, d), 5)


@query("mod_nb_cross_validation", f"with {_CV} select doc_id, fold, label, pred, round(prob, 6) as prob from nb")
def cross_validation(spark, d):
    return rounded(cv_predictions(spark, d), "prob")


_FOLD_METRICS = """c as (select {k}, count(*) filter (label = 1 and pred = 1) as tp, count(*) filter (label = 0 and pred = 1) as fp,
  count(*) filter (label = 1 and pred = 0) as fn, count(*) filter (label = 0 and pred = 0) as tn from {src} group by {k}),
pf as (select {k}, case when tp + fp = 0 then 0.0::double else tp / (tp + fp) end as precision, case when tp + fn = 0 then 0.0::double else tp / (tp + fn) end as recall,
  case when 2 * tp + fp + fn = 0 then 0.0::double else 2 * tp / (2 * tp + fp + fn) end as f1, (tp + tn) / (tp + tn + fp + fn) as accuracy, tp + fn as support_pos, tn + fp as support_neg from c)"""


@query(
    "met_fold_metrics",
    f"with {_CV}, {_FOLD_METRICS.format(k='fold', src='nb')} select fold, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, round(accuracy, 6) as accuracy, support_pos, support_neg from pf",
)
def fold_metrics(spark, d):
    return rounded(M.binary(cv_predictions(spark, d), ["fold"]), "precision", "recall", "f1", "accuracy")


@query(
    "met_fold_summary",
    f"""with {_CV}, {_FOLD_METRICS.format(k='fold', src='nb')} select 'nb' as model, round(avg(f1), 6) as f1_mean, round(stddev_samp(f1), 6) as f1_std,
round(avg(accuracy), 6) as accuracy_mean, round(stddev_samp(accuracy), 6) as accuracy_std from pf""",
)
def fold_summary(spark, d):
    per = M.binary(cv_predictions(spark, d), ["fold"]).withColumn("model", F.lit("nb"))
    return rounded(M.fold_summary(per, ["model"], ["f1", "accuracy"]), "f1_mean", "f1_std", "accuracy_mean", "accuracy_std")


@query("met_errors_by_fold", f"with {_CV} select doc_id, fold, label, pred from nb where label <> pred")
def errors_by_fold(spark, d):
    return M.errors(cv_predictions(spark, d)).select("doc_id", "fold", "label", "pred")


# --- transfer between domains -----------------------------------------------------------

DOMAINS = ["de", "en", "es", "fr"]  # columns of the SQL check; the query takes those of the table
_TR = f"""{LAB}, trw as (select lab.*, domain as src, 1 as copies from lab), tex as (select lab.*, s.src from lab cross join (select distinct domain as src from lab) s),
{nb_sql(test='tex', keys='src', vocab=20000)}, tp as (select doc_id, src as source_domain, domain as target_domain, label, pred from nb),
tc as (select source_domain as s, target_domain as t, c, count(*) filter (label = c and pred = c) as tp, count(*) filter ((label = c) <> (pred = c)) as err from tp cross join (values (0), (1)) z(c) group by 1, 2, 3),
tf as (select s, t, avg(case when 2 * tp + err = 0 then 0.0::double else 2 * tp / (2 * tp + err) end) as f from tc where tp + err > 0 group by 1, 2),
tt as (select a.s as source, a.t as target, a.f as target_f1, b.f as source_f1, case when b.f = 0 then 0.0::double else a.f / b.f end as f1_retention, a.s = a.t as in_sample,
  case when b.f = 0 then 0.0::double else a.f / b.f end >= 0.8 as passed from tf a left join tf b on a.s = b.s and b.s = b.t)"""


def _domains(spark, d):
    """All domains of the table, each a source and a target."""
    found = labelled(spark, d).where(F.col("domain").isNotNull()).select("domain").distinct()
    return sorted(r["domain"] for r in found.collect())


def transfer(spark, d):
    return NB.transfer_predictions(labelled(spark, d), _domains(spark, d))


def transfer_table(spark, d):
    return M.with_retention(M.summary(transfer(spark, d), ["source", "target"]))


@query("met_transfer", f"with {_TR} select source, target, round(target_f1, 6) as target_f1, round(source_f1, 6) as source_f1, round(f1_retention, 6) as f1_retention, in_sample, passed from tt")
def transfer_metrics(spark, d):
    return rounded(transfer_table(spark, d), "target_f1", "source_f1", "f1_retention")


@query(
    "met_transfer_summary",
    f"""with {_TR} select round(avg(target_f1) filter (in_sample), 6) as same_avg, round(avg(target_f1) filter (not in_sample), 6) as cross_avg,
round(avg(f1_retention) filter (not in_sample), 6) as retention_avg, count(*) filter (not in_sample and passed) as n_passed, count(*) filter (not in_sample) as n_pairs,
(select concat(source, '->', target) from tt where not in_sample order by round(target_f1, 9) desc, 1 desc limit 1) as best_pair,
(select concat(source, '->', target) from tt where not in_sample order by round(target_f1, 9), 1 limit 1) as worst_pair from tt""",
)
def transfer_summary(spark, d):
    return rounded(M.transfer_summary(transfer_table(spark, d)), "same_avg", "cross_avg", "retention_avg")


@query(
    "met_transfer_matrix",
    f"with {_TR} select source, " + ", ".join(f"round(max(case when target = '{t}' then target_f1 end), 6) as {t}" for t in DOMAINS) + " from tt group by 1",
)
def transfer_matrix(spark, d):
    domains = _domains(spark, d)
    return rounded(M.transfer_matrix(transfer_table(spark, d), domains), *domains)


@query("met_transfer_errors", f"with {_TR} select doc_id, source_domain, target_domain, label as true_label, pred as pred_label from tp where label <> pred")
def transfer_errors(spark, d):
    wrong = M.errors(transfer(spark, d))
    return wrong.select(
        "doc_id", F.col("source").alias("source_domain"), F.col("target").alias("target_domain"), F.col("label").alias("true_label"),
        F.col("pred").alias("pred_label"),
    )
