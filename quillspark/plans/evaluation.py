"""Queries: metrics, curves, calibration, rejection."""

from pyspark.sql import functions as F

from ..operators import metrics as M
from .base import PRED, any_word, documents, gold, labelled, predictions, query, rounded
from .models import _NB_FULL, nb_predictions
from .weak import _SCORE, NEG, POS

_PRF = """f as (select *, case when tp + fp = 0 then 0.0::double else tp / (tp + fp) end as p, case when tp + fn = 0 then 0.0::double else tp / (tp + fn) end as r,
  case when 2 * tp + fp + fn = 0 then 0.0::double else 2 * tp / (2 * tp + fp + fn) end as f1 from c)"""
_CELLS = """c as (select {k}c as class, count(*) filter (label = c and pred = c) as tp, count(*) filter (label <> c and pred = c) as fp,
  count(*) filter (label = c and pred <> c) as fn, count(*) filter (label = c) as support from {src} cross join (values (0), (1)) z(c) group by all)"""


@query(
    "met_confusion",
    f"with {PRED} select domain, label, count(*) filter (pred = 0) as pred_0, count(*) filter (pred = 1) as pred_1 from pred group by 1, 2",
)
def confusion(spark, d):
    return M.confusion(predictions(spark, d), ["domain"])


@query(
    "met_per_class",
    f"with {PRED}, {_CELLS.format(k='domain, ', src='pred')}, {_PRF} select domain, cast(class as varchar) as class, tp, fp, fn, support, round(p, 6) as precision, round(r, 6) as recall, round(f1, 6) as f1 from f",
)
def per_class(spark, d):
    return rounded(M.per_class(predictions(spark, d), ["domain"]), "precision", "recall", "f1")


@query(
    "met_report_nb",
    f"""with {_NB_FULL}, {_CELLS.format(k='', src='nb')}, {_PRF}
select cast(class as varchar) as class, round(p, 6) as precision, round(r, 6) as recall, round(f1, 6) as f1, support from f where tp + fp + fn > 0
union all select 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), cast(sum(support) as bigint) from f
union all select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), cast(sum(support) as bigint) from f where tp + fp + fn > 0
union all select 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from f""",
)
def report_nb(spark, d):
    return rounded(M.report(nb_predictions(spark, d)), "precision", "recall", "f1")


@query(
    "met_summary_by_domain",
    f"""with {PRED}, {_CELLS.format(k='domain, ', src='pred')}, {_PRF} select domain, cast(sum(support) as bigint) as n, round(sum(tp) / sum(support), 6) as accuracy,
round(avg(f1), 6) as macro_f1, round(sum(f1 * support) / sum(support), 6) as weighted_f1 from f group by 1""",
)
def summary(spark, d):
    return rounded(M.summary(predictions(spark, d), ["domain"]), "accuracy", "macro_f1", "weighted_f1")


@query(
    "met_binary",
    f"""with {PRED}, {_CELLS.format(k='domain, ', src='pred')}, {_PRF}, a as (select domain, sum(tp) / sum(support) as accuracy, cast(max(support) filter (class = 0) as bigint) as sn from f group by 1)
select f.domain, round(p, 6) as precision, round(r, 6) as recall, round(f1, 6) as f1, round(accuracy, 6) as accuracy, support as support_pos, sn as support_neg from f join a using (domain) where class = 1""",
)
def binary(spark, d):
    return rounded(M.binary(predictions(spark, d), ["domain"]), "precision", "recall", "f1", "accuracy")


# --- curves ----------------------------------------------------------------------------

_STEPS = """g as (select {k}prob as score, count(*) filter (label = 1) as dtp, count(*) filter (label <> 1) as dfp from pred group by all),
s as (select *, sum(dtp) over ({p} order by score desc) as tp, sum(dfp) over ({p} order by score desc) as fp, sum(dtp) over ({p}) as np, sum(dfp) over ({p}) as nn from g)"""
_S1 = _STEPS.format(k="", p="")
_SD = _STEPS.format(k="domain, ", p="partition by domain")


@query(
    "met_pr_curve",
    f"with {PRED}, {_S1} select score as threshold, round(tp / (tp + fp), 6) as precision, round(tp / np, 6) as recall from s union all select null, 1.0, 0.0",
)
def pr_curve(spark, d):
    return rounded(M.pr_curve(predictions(spark, d), score="prob"), "precision", "recall")


@query(
    "met_roc_curve",
    f"with {PRED}, {_S1} select score as threshold, round(fp / nn, 6) as fpr, round(tp / np, 6) as tpr from s union all select null, 0.0, 0.0",
)
def roc_curve(spark, d):
    return rounded(M.roc_curve(predictions(spark, d), score="prob"), "fpr", "tpr")


@query(
    "met_curve_areas",
    f"""with {PRED}, {_SD}, q as (select *, lag(tp / (tp + fp), 1, 1.0) over (partition by domain order by score desc) as pprec, tp - dtp as ptp from s)
select domain, round(sum(dtp / np * (tp / (tp + fp))), 6) as average_precision, round(sum(dtp / np * (tp / (tp + fp) + pprec) / 2), 6) as pr_auc,
round(sum(dfp / nn * (tp / np + ptp / np) / 2), 6) as roc_auc from q group by 1""",
)
def curve_areas(spark, d):
    return rounded(M.curve_areas(predictions(spark, d), ["domain"], score="prob"), "average_precision", "pr_auc", "roc_auc")


@query(
    "met_curve_areas_nb",
    f"""with {_NB_FULL}, pred as (select label, round(1 / (1 + exp(least(greatest((s0 - s1) / 100, -500), 500))), 9) as prob from nb), {_S1}, q as (select *, lag(tp / (tp + fp), 1, 1.0) over (order by score desc) as pprec, tp - dtp as ptp from s)
select round(sum(dtp / np * (tp / (tp + fp))), 6) as average_precision, round(sum(dtp / np * (tp / (tp + fp) + pprec) / 2), 6) as pr_auc,
round(sum(dfp / nn * (tp / np + ptp / np) / 2), 6) as roc_auc from q""",
)
def curve_areas_nb(spark, d):
    from ..operators.calibrate import squash

    p = nb_predictions(spark, d).select("label", F.round(squash((F.col("s_m_1") - F.col("s_m_0")) / 100), 9).alias("prob"))
    return rounded(M.curve_areas(p, score="prob"), "average_precision", "pr_auc", "roc_auc")


# --- calibration ---------------------------------------------------------------------------


def _bins_sql(closed):
    edge = "prob > k / 10.0::double and prob <= (k + 1) / 10.0::double" if closed == "right" else "prob >= k / 10.0::double and prob < (k + 1) / 10.0::double"
    return f"""b as (select cast(k as integer) as bin, count(prob) as count, coalesce(avg(label), 0) as accuracy, coalesce(avg(prob), 0) as confidence
  from (select unnest(range(0, 10)) as k) left join pred on {edge} group by 1), n as (select count(*) as n from pred),
bins as (select bin, bin / 10.0::double as bin_lower, (bin + 1) / 10.0::double as bin_upper, count, accuracy, confidence, abs(confidence - accuracy) as gap, count / n as share, n - sum(count) over () as dropped from b cross join n)"""


def _bins_query(closed):
    return (
        f"with {PRED}, {_bins_sql(closed)} select bin, round(bin_lower, 6) as bin_lower, round(bin_upper, 6) as bin_upper, count, round(accuracy, 6) as accuracy, "
        "round(confidence, 6) as confidence, round(gap, 6) as gap, round(share, 6) as share, cast(dropped as bigint) as dropped from bins"
    )


for _c in ("right", "left"):
    query(f"met_calibration_bins_{_c}", _bins_query(_c))(
        lambda spark, d, c=_c: rounded(
            M.calibration_bins(predictions(spark, d), closed=c), "bin_lower", "bin_upper", "accuracy", "confidence", "gap", "share"
        )
    )


@query(
    "met_ece",
    " union all ".join(
        f"select * from (with {PRED}, {_bins_sql(c)} select '{c}' as closed, round(sum(gap * share), 6) as ece, cast(max(dropped) as bigint) as dropped from bins)"
        for c in ("right", "left")
    ),
)
def ece(spark, d):
    p = predictions(spark, d)
    both = [M.ece(p, closed=c).select(F.lit(c).alias("closed"), "ece", "dropped") for c in ("right", "left")]
    return rounded(both[0].unionByName(both[1]), "ece")


@query(
    "met_reliability_curve",
    f"with {PRED}, b as (select cast(case when prob = 1 then 9 else k end as integer) as bin, label, prob from pred join (select unnest(range(0, 10)) as k) on (prob >= k / 10.0::double and prob < (k + 1) / 10.0::double) or (prob = 1 and k = 9)) "
    "select bin, round(avg(prob), 6) as prob_pred, round(avg(label), 6) as prob_true from b group by 1",
)
def reliability(spark, d):
    return rounded(M.reliability_curve(predictions(spark, d)), "prob_pred", "prob_true")


@query(
    "cal_squash",
    f"with {_NB_FULL} select doc_id, round(1 / (1 + exp(-((s1 - s0) / 100))), 6) as prob from nb",
)
def squash_margins(spark, d):
    from ..operators.calibrate import squash

    p = nb_predictions(spark, d)
    return rounded(p.select("doc_id", squash((F.col("s_m_1") - F.col("s_m_0")) / 100).alias("prob")), "prob")


# --- rejection -------------------------------------------------------------------------------

_KEEP = {"positive": "prob >= 0.9::double", "both": "(prob > 0.9::double or prob < 1 - 0.9::double)"}


@query(
    "met_reject",
    f"with {PRED} "
    + " union all ".join(
        f"select '{s}' as side, 0.9::double as threshold, round(coalesce(avg(cast(pred = label as integer)) filter ({k}), 0), 6) as accuracy, "
        f"round(count(*) filter ({k}) / count(*), 6) as coverage, count(*) filter ({k}) as count, round(1 - count(*) filter ({k}) / count(*), 6) as review_load from pred"
        for s, k in _KEEP.items()
    ),
)
def reject(spark, d):
    p = predictions(spark, d)
    a, b = [M.reject(p, 0.9, s).select(F.lit(s).alias("side"), "*") for s in ("positive", "both")]
    return rounded(a.unionByName(b), "accuracy", "coverage", "review_load")


_SWEEP = f"""{PRED}, g as (select unnest(range(50, 100)) as k), a as (select avg(cast(pred = label as integer)) as baseline, count(*) as n from pred),
sw as (select k / 100 as threshold, coalesce(avg(cast(pred = label as integer)), 0) as accuracy, count(prob) / max(n) as coverage, count(prob) as count, max(baseline) as baseline
  from g cross join a left join pred on prob >= k / 100 group by k)"""


@query("met_reject_sweep", f"with {_SWEEP} select threshold, round(accuracy, 6) as accuracy, round(coverage, 6) as coverage, count, round(baseline, 6) as baseline from sw")
def sweep(spark, d):
    return rounded(M.reject_sweep(predictions(spark, d)), "accuracy", "coverage", "baseline")


def _best_sql(cov, gain, cov2, gain2):
    return f"""with {_SWEEP}, s1 as (select 'strict' as rule, * from sw where coverage >= {cov} and accuracy >= baseline + {gain} and accuracy > 0 order by accuracy desc, threshold limit 1),
s2 as (select 'relaxed' as rule, * from sw where coverage >= {cov2} and accuracy >= baseline + {gain2} and accuracy > 0 order by accuracy desc, threshold limit 1),
u as (select 1 as o, * from s1 union all select 2, * from s2 union all select 3, 'none', null, null, null, null, (select max(baseline) from sw))
select rule, round(baseline, 6) as baseline, threshold, round(accuracy, 6) as accuracy, round(coverage, 6) as coverage from u order by o limit 1"""


@query("met_best_threshold", _best_sql(0.5, 0.03, 0.3, 0.02))
def best(spark, d):
    return rounded(M.best_threshold(M.reject_sweep(predictions(spark, d))), "baseline", "accuracy", "coverage")


@query("met_best_threshold_loose", _best_sql(0.4, 0.001, 0.05, -0.2))
def best_loose(spark, d):
    s = M.reject_sweep(predictions(spark, d))
    return rounded(M.best_threshold(s, coverage=0.4, gain=0.001, relaxed=(0.05, -0.2)), "baseline", "accuracy", "coverage")


# --- slices and targets --------------------------------------------------------------------------


@query(
    "met_slice_error_rate",
    f"""with x as (select d.lang as domain, d.text, cast(l.quality as integer) as label, cast({_SCORE} >= 0.5 as integer) as pred from documents d join labels l using (doc_id))
select domain, count(*) filter ({any_word(NEG)}) as n, round(avg(cast(pred <> label as integer)) filter ({any_word(NEG)}), 6) as error_rate from x group by 1""",
)
def slice_error(spark, d):
    from ..functions import rules as R
    from ..functions.text import contains_any

    x = labelled(spark, d).withColumn("pred", R.threshold_label(R.lexicon_score(F.col("text"), POS, NEG)))
    return rounded(M.slice_error_rate(x, contains_any(F.col("text"), NEG), ["domain"]), "error_rate")


@query(
    "met_targets",
    f"""with {PRED}, {_CELLS.format(k='', src='pred')}, {_PRF}, m as (select sum(tp) / sum(support) as accuracy, avg(f1) as macro_f1 from f),
l as (select 'accuracy' as metric, accuracy as value, 0.4 as target from m union all select 'macro_f1', macro_f1, 0.65 from m)
select metric, round(value, 6) as value, cast(target as double) as target, value >= target as met from l""",
)
def targets(spark, d):
    s = M.summary(predictions(spark, d))
    long = s.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("accuracy", "macro_f1")])).alias("e")).select("e.*")
    return rounded(M.targets_met(long, {"accuracy": 0.4, "macro_f1": 0.65}), "value")


@query(
    "mod_stage_tag",
    f"""with {PRED}, {_CELLS.format(k='domain, ', src='pred')}, {_PRF}, m as (select domain, avg(f1) as macro_f1 from f group by 1)
select domain, round(macro_f1, 6) as macro_f1, case when macro_f1 > 0.45 then 'production' else 'staging' end as stage from m""",
)
def stage_tag(spark, d):
    from ..operators.linear import stage_tag as tag

    return rounded(tag(M.summary(predictions(spark, d), ["domain"]), above=0.45).select("domain", "macro_f1", "stage"), "macro_f1")
