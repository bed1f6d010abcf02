"""Queries: splits, folds, samples, balancing."""

from pyspark.sql import functions as F

from ..operators import balance as B, sampling as S, splits as SP
from ..operators.ranking import top_n
from .base import LAB, PRED, documents, h, hint, labelled, predictions, query, rank, rounded, table

_R = f"r as (select *, {rank('label')} as rk, count(*) over (partition by label) as n from lab)"
_TEST = "case when n >= 2 then least(greatest(floor(0.2::double * n + 0.5::double), 1), n - 1) else 0 end"


@query("spl_holdout", f"with {LAB}, {_R} select doc_id, label, case when rk <= {_TEST} then 'test' else 'train' end as split from r")
def holdout(spark, d):
    return SP.stratified_holdout(labelled(spark, d)).select("doc_id", "label", "split")


@query(
    "spl_three_way",
    f"with {LAB}, {_R} select doc_id, label, case when rk <= floor(0.8::double * n + 0.5::double) then 'train' "
    "when rk <= floor(0.9::double * n + 0.5::double) then 'valid' else 'test' end as split from r",
)
def three_way(spark, d):
    return SP.stratified_parts(labelled(spark, d)).select("doc_id", "label", "split")


@query(
    "spl_60_20_20",
    f"with {LAB}, {_R} select doc_id, label, case when rk <= floor(0.6::double * n + 0.5::double) then 'train' "
    "when rk <= floor(0.8::double * n + 0.5::double) then 'valid' else 'test' end as split from r",
)
def sixty(spark, d):
    parts = (("train", 0.6), ("valid", 0.2), ("test", 0.2))
    return SP.stratified_parts(labelled(spark, d), parts).select("doc_id", "label", "split")


@query("spl_folds", f"with {LAB}, {_R} select doc_id, label, cast((rk - 1) % 5 as integer) as fold from r")
def folds(spark, d):
    return SP.stratified_folds(labelled(spark, d)).select("doc_id", "label", "fold")


@query(
    "spl_rare_class",
    f"""with {LAB}, m as (select min(c) >= 2 as ok from (select count(*) as c from lab group by source)),
x as (select lab.*, case when ok then source else '*' end as stratum from lab cross join m),
r as (select *, {rank('stratum')} as rk, count(*) over (partition by stratum) as n from x)
select doc_id, source, case when rk <= {_TEST} then 'test' else 'train' end as split from r""",
)
def rare(spark, d):
    return SP.rare_class_split(labelled(spark, d), label="source").select("doc_id", "source", "split")


@query("smp_sample_n", f"select doc_id, lang as domain from documents order by {h()}, doc_id limit 100")
def sample_n(spark, d):
    return S.sample_n(documents(spark, d).select("doc_id", "domain"), 100)


@query("smp_per_label_cap", f"with {LAB}, {_R} select doc_id, label from r where rk <= 200")
def cap(spark, d):
    return S.per_group(labelled(spark, d), 200, keys=["label"]).select("doc_id", "label")


@query("smp_per_class", f"with {LAB}, {_R} select doc_id, label from r where rk <= 30")
def per_class(spark, d):
    return S.per_group(labelled(spark, d), 30, keys=["label"]).select("doc_id", "label")


@query("smp_balanced_down", f"with {LAB}, {_R} select doc_id, label from r where rk <= (select min(n) from r)")
def balanced(spark, d):
    return S.balanced_down(labelled(spark, d)).select("doc_id", "label")


_QUOTA = """c as (select domain, count(*) as n from d group by 1), t as (select domain, n, least(200, sum(n) over ()) as size, sum(n) over () as total from c),
q as (select *, (n * size) // total as base, (n * size) % total as rem from t),
quota as (select domain, base + cast(row_number() over (order by rem desc, domain) <= size - sum(base) over () as integer) as quota from q)"""


@query(
    "smp_proportional",
    f"""with d as (select doc_id, lang as domain from documents), {_QUOTA},
r as (select doc_id, domain, {rank('domain')} as rk from d) select doc_id, domain from r join quota using (domain) where rk <= quota""",
)
def proportional(spark, d):
    return S.proportional_sample(documents(spark, d).select("doc_id", "domain"), 200, label="domain")


@query(
    "smp_few_shot",
    f"""with {LAB}, {_R}, test as (select doc_id from r where rk <= {_TEST}),
x as (select doc_id, label, left(text, 100) as text, {rank('label')} as k from lab where doc_id not in (select doc_id from test))
select doc_id, label, text from x where k <= 2""",
)
def few_shot(spark, d):
    lab = labelled(spark, d)
    test = SP.stratified_holdout(lab.select("doc_id", "label")).where("split = 'test'")
    return S.few_shot_examples(lab.select("doc_id", "label", "text"), test, 5)


@query(
    "smp_errors_per_group",
    f"with {PRED} select id, domain, event_type, k from (select *, cast(row_number() over (partition by domain, event_type order by {h('id')}, id) as integer) as k from pred where label <> pred) where k <= 30",
)
def errors_per_group(spark, d):
    from ..functions.hashing import hash_key

    wrong = predictions(spark, d).where("label <> pred").select("id", "domain", "event_type")
    return top_n(wrong, ["domain", "event_type"], [hash_key("id", 42), "id"], 30, rank="k")


@query("smp_domain_errors", f"with {PRED} select id, domain, event_type from pred where label <> pred and (domain ilike '%D1%' or event_type ilike '%err%') order by id limit 100")
def domain_errors(spark, d):
    wrong = predictions(spark, d).where("label <> pred").select("id", "domain", "event_type")
    return S.domain_errors(wrong, "D1|err", 100, columns=["domain", "event_type"], id_col="id")


@query(
    "smp_simulated_errors",
    f"""with {LAB}, s as (select doc_id, label from lab order by {h()}, doc_id limit 50)
select doc_id, label, cast(1 - label as integer) as pred from s where {hint(h('doc_id', '42-flip'))} % 10000 < 3000""",
)
def simulated(spark, d):
    return S.simulated_errors(labelled(spark, d).select("doc_id", "label")).select("doc_id", "label", F.col("pred").cast("int").alias("pred"))


@query("smp_least_confident", f"with {PRED} select id, round(prob, 6) as prob from pred order by abs(prob - 0.5), id limit 100")
def least_confident(spark, d):
    p = predictions(spark, d).select("id", "prob")
    return rounded(S.least_confident(p, 100, score="prob", id_col="id"), "prob")


# --- balancing ---------------------------------------------------------------------------

_CYC = "case when {t} > n then ({t} - rk) // n + 1 else 1 end"


@query(
    "bal_upsample_majority",
    f"""with {LAB}, {_R}, m as (select max(n) as mx, min(n) as mn, count(distinct label) as k from r),
x as (select r.*, case when k > 1 and mn < greatest(5.0, mx * 0.2::double) then {_CYC.format(t='mx')} else 1 end as copies from r cross join m)
select doc_id, label, unnest(range(0, cast(copies as bigint))) as copy from x""",
)
def upsample(spark, d):
    return B.upsample_to_majority(labelled(spark, d).select("doc_id", "label")).select("doc_id", "label", "copy")


@query(
    "bal_upsample_events",
    f"""with e as (select event_id, case when event_type = 'error' and user_id < 20 then 1 else 0 end as label from events),
r as (select *, {rank('label', 'event_id')} as rk, count(*) over (partition by label) as n from e), m as (select max(n) as mx, min(n) as mn from r),
x as (select label, case when mn < greatest(5.0, mx * 0.2::double) then {_CYC.format(t='mx')} else 1 end as copies from r cross join m)
select cast(label as integer) as label, cast(sum(copies) as bigint) as n, count(*) as originals, cast(max(copies) as bigint) as most from x group by 1""",
)
def upsample_events(spark, d):
    e = table(spark, d, "events").select("event_id", F.when((F.col("event_type") == "error") & (F.col("user_id") < 20), 1).otherwise(0).alias("label"))
    up = B.upsample_to_majority(e, id_col="event_id")
    return up.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(F.col("copy") == 0).alias("originals"), (F.max("copy") + 1).alias("most")
    )


@query(
    "bal_oversample_half",
    f"""with {LAB}, {_R}, m as (select cast(floor(0.5::double * max(n)) as bigint) as target from r),
x as (select r.*, {_CYC.format(t='target')} as copies from r cross join m)
select doc_id, label, unnest(range(0, cast(copies as bigint))) as copy from x""",
)
def oversample(spark, d):
    return B.oversample_to_ratio(labelled(spark, d).select("doc_id", "label")).select("doc_id", "label", "copy")


@query("bal_repeat", "select doc_id, cast(quality as integer) as label, unnest(range(0, 3)) as copy from labels")
def repeat(spark, d):
    from .base import gold

    return B.repeat(gold(spark, d), 3)


@query(
    "bal_class_weights",
    "with c as (select cast(quality as integer) as label, count(*) as n from labels group by 1) select label, n, round(sum(n) over () / (count(*) over () * n), 6) as weight from c",
)
def class_weights(spark, d):
    from .base import gold

    return rounded(B.class_weights(gold(spark, d)), "weight")
