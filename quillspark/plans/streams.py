"""Queries: streaming twins, drained over the test tables."""

from pyspark.sql import functions as F

from ..operators import bayes as NB
from ..session import staging_path
from ..streaming import drift_windows as DW, monitor as MO
from .base import PRED, query, rounded, table
from .models import VOCAB, _BAL, _SPLIT, nb_fitted, nb_sql
from .profiling import _js_sql, _ks_sql
from .weak import NAMES, RULES, VOTES_SQL, _sum


def _stream(spark, d, name):
    # A table is a file or a folder of files; a stream takes both by a pattern, and only folders by a plain path.
    return MO.file_stream(spark, f"{d}/{name}.parque[t]", table(spark, d, name).schema)


def event_stream(spark, d):
    """The event log as a stream of predictions."""
    e = _stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    prob = F.col("value") / (F.col("value") + F.lit(20.0))
    return e.select(
        F.col("event_id").alias("id"), "ts", "event_type", "value", prob.alias("prob"), (prob >= 0.5).cast("int").alias("pred"),
        F.col("event_type").isin("purchase", "signup").cast("int").alias("label"),
    )


@query(
    "str_label_stream",
    f"with v as (select doc_id, {VOTES_SQL} from documents), s as (select doc_id, {_sum('= 1')} as pw, {_sum('= 0')} as nw from v) "
    "select doc_id, cast(pw > nw as integer) as weak_label, round(case when pw + nw = 0 then 0.5 else greatest(pw, nw) / (pw + nw) end, 6) as confidence from s",
)
def label_stream(spark, d):
    s = MO.label_stream(_stream(spark, d, "documents"), RULES).select("doc_id", "weak_label", "confidence")
    return rounded(MO.drain(s, "labels"), "confidence")


@query(
    "str_score_stream",
    f"with {_SPLIT}, {_BAL}, te as (select doc_id from documents), tex as (select doc_id, text from documents), {nb_sql(test='tex')} select doc_id, round(prob, 6) as prob, cast(prob > 0.5 as integer) as label from nb",
)
def score_stream(spark, d):
    """Arriving documents scored by the fitted Naive Bayes model."""
    from ..session import stage

    _, model, prior = nb_fitted(spark, d)
    model, prior = stage(model, "nb-model"), stage(prior, "nb-prior")

    def work(batch):
        scored = NB.score(batch.select("doc_id", "text"), model, prior, ["m"])
        _, prob = NB.predict(scored, "m")
        return scored.select("doc_id", prob.alias("prob"), (prob > 0.5).cast("int").alias("label"))

    out = MO.drain_per_batch(_stream(spark, d, "documents"), work, "scores", "doc_id bigint, prob double, label int")
    return rounded(out.drop("batch_id"), "prob")


_CLOSED = "date_trunc('day', ts) + interval 1 day <= (select max(ts) from pred) - interval 1 hour"


@query(
    "str_prediction_monitor",
    f"""with {PRED} select date_trunc('day', ts) as window_start, count(*) as n, round(avg(prob), 6) as mean_score, round(avg(cast(abs(prob - 0.5) < 0.1 as integer)), 6) as low_confidence_share,
avg(cast(abs(prob - 0.5) < 0.1 as integer)) > 0.2 as alert from pred where {_CLOSED} group by 1""",
)
def prediction_monitor(spark, d):
    out = MO.drain(MO.prediction_monitor(event_stream(spark, d)), "monitor")
    return rounded(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), "mean_score", "low_confidence_share")


@query(
    "str_latency_monitor",
    f"""with {PRED} select date_trunc('day', ts) as window_start, count(*) as n, quantile_disc(value, 0.5) as p50, quantile_disc(value, 0.95) as p95, quantile_disc(value, 0.99) as p99,
quantile_disc(value, 0.95) > 50 as alert from pred where {_CLOSED} group by 1""",
)
def latency_monitor(spark, d):
    out = MO.drain(MO.latency_monitor(event_stream(spark, d), limit=50.0), "latency")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


_MATCH = f"{PRED}, fb as (select id, ts + interval 1 hour * (id % 72) as feedback_ts, label from pred), mt as (select p.id, p.ts, p.pred, fb.label from pred p join fb using (id) where fb.feedback_ts <= p.ts + interval 2 day)"


def matched_feedback(spark, d):
    preds = event_stream(spark, d)
    fb = event_stream(spark, d).select(
        "id", (F.col("ts") + F.make_interval(hours=(F.col("id") % 72).cast("int"))).alias("feedback_ts"), "label"
    )
    return MO.drain(MO.match_feedback(preds, fb), "feedback")


@query("str_match_feedback", f"with {_MATCH} select id, pred, label from mt")
def match_feedback(spark, d):
    return matched_feedback(spark, d).select("id", "pred", "label")


@query(
    "str_feedback_accuracy",
    f"with {_MATCH} select date_trunc('day', ts) as window_start, count(*) as n, round(avg(cast(pred = label as integer)), 6) as accuracy, avg(cast(pred = label as integer)) < 0.5 - 0.05 as alert from mt group by 1",
)
def feedback_accuracy(spark, d):
    out = MO.feedback_accuracy(matched_feedback(spark, d), 0.5)
    return rounded(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), "accuracy")


@query(
    "str_windowed_drift",
    f"""with sides as (select value, event_type, 'current' as side from events union all select value, event_type, 'reference' from events where ts < timestamp '2024-01-20'),
{_ks_sql('sides', 'value')}, {_js_sql('sides', 'event_type')}, c as (select statistic > critical as drifted from ks union all select js > 0.1 from js)
select round(avg(cast(drifted as integer)), 6) as drift_share, count(*) filter (drifted) as n_drifted,
case when avg(cast(drifted as integer)) > 0.3 then 'WARNING' when avg(cast(drifted as integer)) > 0 then 'INFO' else 'OK' end as status from c""",
)
def windowed_drift(spark, d):
    ref = table(spark, d, "events").where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    work = MO.drift_against(ref, ["value"], ["event_type"])
    out = MO.drain_per_batch(event_stream(spark, d), work, "drift", "drift_share double, n_drifted bigint, status string")
    return rounded(out.drop("batch_id"), "drift_share")


_CUT = "greatest(length(bin(x)) - 8, 0)"


@query(
    "str_drift_windows",
    f"""with {PRED}, ev as (select date_trunc('day', ts) as w, ts, value, event_type, cast(floor(abs(value) * 100.0::double) as bigint) as x from events),
ek as (select *, case when value < 0 then -1 else 1 end * ((x >> {_CUT}) << {_CUT}) as k from ev),
cl as (select * from ek where w + interval 1 day <= (select max(ts) from pred) - interval 1 hour), ws as (select w, count(*) as n_rows from cl group by 1),
rf as (select * from ek where ts < timestamp '2024-01-20'),
nu as (select w, k, sum(a) as a, sum(c) as c from (select w, k, 0 as a, 1 as c from cl union all select ws.w, k, 1, 0 from rf, ws) where k is not null group by 1, 2),
nc as (select w, sum(a) over o as ca, sum(c) over o as cc, sum(a) over p as na, sum(c) over p as nb from nu window o as (partition by w order by k), p as (partition by w)),
ks as (select w, max(abs(ca::double / na - cc::double / nb)) > 1.3581::double * sqrt((max(na)::double + max(nb)) / (max(na)::double * max(nb))) as drifted from nc group by 1),
ca as (select w, event_type, sum(a) as a, sum(c) as c from (select w, event_type, 0 as a, 1 as c from cl union all select ws.w, event_type, 1, 0 from rf, ws) group by 1, 2),
cp as (select w, a::double / sum(a) over (partition by w) as p, c::double / sum(c) over (partition by w) as q from ca),
js as (select w, sqrt(greatest(sum((case when p > 0 then p * ln(p / ((p + q) / 2)) else 0 end + case when q > 0 then q * ln(q / ((p + q) / 2)) else 0 end) / 2) / ln(2.0::double), 0)) > 0.1 as drifted from cp group by 1),
al as (select w, avg(cast(drifted as integer)) as s, count(*) filter (drifted) as n_drifted from (select * from ks union all select * from js) group by 1)
select w as window_start, n_rows, round(s, 6) as drift_share, n_drifted, case when s > 0.3 then 'WARNING' when s > 0 then 'INFO' else 'OK' end as status from ws join al using (w)""",
)
def drift_windows(spark, d):
    """Drift of each day of the event stream against the first days, read once."""
    numeric, categories = {"value": 100.0}, ["event_type"]
    ref = DW.reference_sketch(table(spark, d, "events").where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")), numeric, categories)
    root = staging_path(spark, "drift-windows")
    DW.windowed_drift(event_stream(spark, d), ref, numeric, categories, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    out = spark.read.schema(DW.SCHEMA + ", batch_id int").parquet(f"{root}/data").drop("batch_id")
    return rounded(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), "drift_share")
