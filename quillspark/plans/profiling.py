"""Queries: profiles, validation, drift."""

from pyspark.sql import functions as F

from ..operators import drift as D, profile as P, splits as SP, validate as V
from .base import LAB, PRED, TOKENS, documents, h, labelled, predictions, query, rounded, table


@query(
    "eda_length_stats",
    "select lang as domain, count(*) as nrows, round(avg(length(text)), 6) as avg_len, cast(median(length(text)) as double) as median_len from documents group by 1",
)
def length_stats(spark, d):
    return rounded(P.length_stats(documents(spark, d), ["domain"]), "avg_len")


_LEN = "least(length(text), 500)"


@query(
    "eda_length_histogram",
    f"select cast(least(floor(({_LEN} - 0.0::double) * 50 / 500.0::double), 49) as integer) as bin, count(*) as n from documents group by 1",
)
def histogram(spark, d):
    return P.length_histogram(F.length("text"), documents(spark, d), lo=0.0, hi=500.0)


@query(
    "eda_length_histogram_by_domain",
    "select lang as domain, cast(case when length(text) > 20000 then 50 else least(floor((length(text) - 0.0::double) * 50 / 20000.0::double), 49) end as integer) as bin, "
    "count(*) as n from documents group by 1, 2",
)
def histogram_domain(spark, d):
    return P.length_histogram(F.length("text"), documents(spark, d), lo=0.0, hi=20000.0, clip=None, keys=["domain"])


@query("eda_label_distribution", f"with {LAB} select domain, label, count(*) as n from lab group by 1, 2")
def label_distribution(spark, d):
    return P.label_distribution(labelled(spark, d), keys=["domain"])


@query("eda_label_counts_with_null", "select cast(l.quality as integer) as label, count(*) as n from documents d left join labels l using (doc_id) group by 1")
def label_counts(spark, d):
    from .base import gold

    df = documents(spark, d).select("doc_id").join(gold(spark, d), "doc_id", "left")
    return P.label_distribution(df)


@query("eda_head", "select doc_id, lang as domain, source, n_chars from documents order by doc_id limit 20")
def head(spark, d):
    return P.head(documents(spark, d).select("doc_id", "domain", "source", "n_chars"))


@query(
    "eda_imbalance",
    f"""with {LAB}, c as (select domain, label, count(*) as n from lab group by 1, 2)
select domain, max(n) as max_n, min(n) as min_n, round(max(n) / min(n), 6) as ratio, case when max(n) / min(n) > 10 then 'imbalanced' else 'balanced' end as verdict
from c group by 1""",
)
def imbalance(spark, d):
    return rounded(P.imbalance(labelled(spark, d), keys=["domain"]), "ratio")


_CLASSES = """with c as (select cast({column} as varchar) as class, count(*) as n from {table} group by 1)
select 'class' as kind, class, n, cast(null as bigint) as largest, cast(null as bigint) as smallest from c
union all select 'summary', concat(cast(count(*) as varchar), ' classes'), cast(sum(n) as bigint), max(n), min(n) from c"""


@query(
    "eda_class_table",
    _CLASSES.format(column="quality", table="labels"),
)
def class_table(spark, d):
    from .base import gold

    return P.class_table(gold(spark, d))


@query(
    "eda_many_classes",
    _CLASSES.format(column="user_id", table="events"),
)
def many_classes(spark, d):
    return P.class_table(table(spark, d, "events"), label="user_id")


@query(
    "eda_unlabelled_lengths",
    r"""select doc_id, cast(length(text) as integer) as char_len, cast(len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) as integer) as word_count
from documents where doc_id not in (select doc_id from labels)""",
)
def unlabelled_lengths(spark, d):
    rest = documents(spark, d).join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")
    return P.text_lengths(rest)


@query(
    "met_latency",
    """select event_type, count(*) as n, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.95), 6) as p95,
round(avg(value), 6) as mean from events group by 1""",
)
def latency(spark, d):
    return rounded(P.latency(table(spark, d, "events"), keys=["event_type"]), "p50", "p95", "mean")


# --- validation ------------------------------------------------------------------------

_CHECKS = f"""{LAB}, a as (select domain, count(*) as n, count(*) filter (text is null) as nt, count(*) filter (label is null) as nl,
  count(*) filter (label not in (0, 1)) as bad, nullif(count(*) filter (label = 0), 0) as c0, nullif(count(*) filter (label = 1), 0) as c1,
  count(*) filter (length(text) < 5) as short, count(*) filter (length(text) > 1000) as long from lab group by 1),
r as (select *, greatest(c0, c1) / least(c0, c1) as ratio from a),
checks as (
  select domain as dataset, n as rows, 'missing_columns' as "check", 'error' as severity, 0.0::double as value, true as passed from r
  union all select domain, n, 'nulls:text', 'error', nt, nt = 0 from r union all select domain, n, 'nulls:label', 'error', nl, nl = 0 from r
  union all select domain, n, 'label_domain', 'error', bad, bad = 0 from r
  union all select domain, n, 'class_ratio', 'warning', ratio, coalesce(ratio <= 3, true) from r
  union all select domain, n, 'too_short', 'warning', short, short = 0 from r union all select domain, n, 'too_long', 'warning', long, long = 0 from r)"""


def _checks(spark, d):
    return V.checks(labelled(spark, d), keys=["domain"])


@query("val_checks", f"with {_CHECKS} select dataset, rows, \"check\", severity, round(value, 6) as value, passed from checks")
def checks(spark, d):
    return rounded(_checks(spark, d), "value")


_STATUS = """st as (select dataset, max(rows) as rows, count(*) filter (not passed and severity = 'error') as n_errors,
  count(*) filter (not passed and severity = 'warning') as n_warnings from checks group by 1),
st2 as (select *, case when rows = 0 then 'SKIPPED' when n_errors > 0 then 'FAILED' else 'PASSED' end as status from st)"""


@query("val_status", f"with {_CHECKS}, {_STATUS} select * from st2")
def status(spark, d):
    return V.status(_checks(spark, d))


@query(
    "val_overall",
    f"""with {_CHECKS}, {_STATUS} select bool_and(status in ('PASSED', 'SKIPPED')) as all_passed, count(*) filter (status = 'PASSED') as n_passed,
count(*) filter (status = 'FAILED') as n_failed, count(*) filter (status = 'SKIPPED') as n_skipped from st2""",
)
def overall(spark, d):
    return V.overall(V.status(_checks(spark, d)))


_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("val_null_counts", " union all ".join(f"select '{c}' as \"column\", count(*) filter ({c} is null) as n_null from lineitem" for c in _LI))
def null_counts(spark, d):
    return V.null_counts(table(spark, d, "lineitem").select(*_LI))


# --- drift ------------------------------------------------------------------------------

_SIDES = f"""o as (select *, row_number() over (order by o_orderdate, {h('o_orderkey')}, o_orderkey) as rn, count(*) over () as n from orders),
sides as (select *, case when rn <= floor(0.8::double * n) then 'reference' else 'current' end as side from o)"""


def order_sides(spark, d, *cols):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", *cols)
    return SP.sequential_split(o, order="o_orderdate", id_col="o_orderkey")


@query("drf_sequential_split", f"with {_SIDES} select o_orderkey, side from sides")
def sequential(spark, d):
    return order_sides(spark, d).select("o_orderkey", "side")


@query(
    "spl_sequential_documents",
    f"""with o as (select doc_id, row_number() over (order by doc_id) as rn, count(*) over () as n from documents)
select doc_id, case when rn <= floor(0.8::double * n) then 'train' else 'test' end as split from o""",
)
def sequential_docs(spark, d):
    df = documents(spark, d).select("doc_id")
    return SP.sequential_split(df, order="doc_id", id_col="doc_id", names=("train", "test"), out="split")


def _ks_sql(tbl, col, out="ks"):
    return f"""{out}_c as (select {col} as x, count(*) filter (side = 'reference') as a, count(*) filter (side = 'current') as b from {tbl} where {col} is not null group by 1),
{out}_w as (select x, sum(a) over (order by x) as ca, sum(b) over (order by x) as cb, sum(a) over () as na, sum(b) over () as nb from {out}_c),
{out} as (select 'ks' as test, max(abs(ca::double / na - cb::double / nb)) as statistic,
  1.3581::double * sqrt((max(na)::double + max(nb)) / (max(na)::double * max(nb))) as critical from {out}_w)"""


def _js_sql(tbl, col, out="js"):
    return f"""{out}_c as (select {col} as x, count(*) filter (side = 'reference') as a, count(*) filter (side = 'current') as b from {tbl} group by 1),
{out}_p as (select x, a, b, a::double / sum(a) over () as p, b::double / sum(b) over () as q, (a + 0.5::double) / (sum(a) over () + count(*) over () * 0.5::double) as sp,
  (b + 0.5::double) / (sum(b) over () + count(*) over () * 0.5::double) as sq, sum(a) over () as na, sum(b) over () as nb from {out}_c),
{out} as (select sqrt(greatest(sum((case when p > 0 then p * ln(p / ((p + q) / 2)) else 0 end + case when q > 0 then q * ln(q / ((p + q) / 2)) else 0 end) / 2) / ln(2.0::double), 0)) as js,
  sum(pow(b - nb::double * (a + b) / (na + nb), 2) / (nb::double * (a + b) / (na + nb)) + pow(a - na::double * (a + b) / (na + nb), 2) / (na::double * (a + b) / (na + nb))) as chi_square,
  count(*) as n_values, sum(sp * ln(sp / sq)) as kl from {out}_p)"""




@query("drf_ks_price", f"with {_SIDES}, {_ks_sql('sides', 'o_totalprice')} select test, round(statistic, 6) as statistic, round(critical, 6) as critical, statistic > critical as drifted from ks")
def ks_price(spark, d):
    return rounded(D.ks(order_sides(spark, d, "o_totalprice"), "o_totalprice"), "statistic", "critical")


@query(
    "drf_ks_lineitem_quantity",
    f"""with n as (select l_shipdate, count(*) as c from lineitem group by 1), w as (select l_shipdate, sum(c) over (order by l_shipdate) as cum, sum(c) over () as n from n),
cut as (select min(l_shipdate) as cut_at from w where cum > floor(0.8::double * n)), sides as (select l_quantity, case when l_shipdate < cut_at then 'reference' else 'current' end as side from lineitem cross join cut),
{_ks_sql('sides', 'l_quantity')} select test, round(statistic, 6) as statistic, round(critical, 6) as critical, statistic > critical as drifted from ks""",
)
def ks_lineitem(spark, d):
    li = table(spark, d, "lineitem").select("l_shipdate", "l_quantity")
    return rounded(D.ks(SP.split_at_value(li, order="l_shipdate"), "l_quantity"), "statistic", "critical")


@query(
    "drf_column_drift",
    f"""with {_SIDES}, {_ks_sql('sides', 'o_totalprice')}, {_js_sql('sides', 'o_orderstatus', 'j1')}, {_js_sql('sides', 'o_orderpriority', 'j2')}
select 'o_totalprice' as "column", test, round(statistic, 6) as statistic, round(critical, 6) as critical, statistic > critical as drifted from ks
union all select 'o_orderstatus', 'js', round(js, 6), 0.1, js > 0.1 from j1 union all select 'o_orderpriority', 'js', round(js, 6), 0.1, js > 0.1 from j2""",
)
def column_drift(spark, d):
    sides = order_sides(spark, d, "o_totalprice", "o_orderstatus", "o_orderpriority")
    return rounded(D.column_drift(sides, ["o_totalprice"], ["o_orderstatus", "o_orderpriority"]), "statistic", "critical")


def _review_sides(spark, d):
    df = labelled(spark, d).withColumn("text_length", F.length("text"))
    return SP.sequential_split(df, order="doc_id", id_col="doc_id")


_REVIEW = f"""{LAB}, o as (select *, length(text) as text_length, row_number() over (order by doc_id) as rn, count(*) over () as n from lab),
sides as (select *, case when rn <= floor(0.8::double * n) then 'reference' else 'current' end as side from o)"""
_REVIEW_DRIFT = f"""{_REVIEW}, {_ks_sql('sides', 'text_length')}, {_js_sql('sides', 'label', 'j1')}, {_js_sql('sides', 'domain', 'j2')},
cols as (select statistic > critical as drifted from ks union all select js > 0.1 from j1 union all select js > 0.1 from j2)"""


@query(
    "drf_status",
    f"""with {_REVIEW_DRIFT} select round(avg(cast(drifted as integer)), 6) as drift_share, count(*) filter (drifted) as n_drifted,
case when avg(cast(drifted as integer)) > 0.3 then 'WARNING' when avg(cast(drifted as integer)) > 0 then 'INFO' else 'OK' end as status from cols""",
)
def drift_status(spark, d):
    cols = D.column_drift(_review_sides(spark, d), ["text_length"], ["label", "domain"])
    return rounded(D.drift_status(cols), "drift_share")


@query(
    "drf_exit_status",
    f"""with {_REVIEW_DRIFT}, {_SIDES.replace('sides as', 'sides2 as').replace('o as', 'o2 as').replace('from o)', 'from o2)')}, {_ks_sql('sides2', 'o_totalprice', 'k2')},
s as (select case when avg(cast(drifted as integer)) > 0.3 then 'WARNING' when avg(cast(drifted as integer)) > 0 then 'INFO' else 'OK' end as status from cols
  union all select case when statistic > critical then 'WARNING' else 'OK' end from k2)
select bool_or(status = 'WARNING') as alert, count(*) as n_datasets from s""",
)
def exit_status(spark, d):
    a = D.drift_status(D.column_drift(_review_sides(spark, d), ["text_length"], ["label", "domain"]))
    b = D.drift_status(D.column_drift(order_sides(spark, d, "o_totalprice"), ["o_totalprice"], []))
    return D.exit_status(a.unionByName(b))


@query(
    "drf_quality",
    f"""with {_SIDES} select side, 'o_totalprice' as "column", count(*) as rows, count(*) filter (o_totalprice is null) as n_null, count(distinct o_totalprice) as n_distinct,
min(o_totalprice) as min, max(o_totalprice) as max, round(avg(o_totalprice), 4) as mean, round(stddev_samp(o_totalprice), 4) as std from sides group by 1
union all select side, 'o_custkey', count(*), count(*) filter (o_custkey is null), count(distinct o_custkey), min(o_custkey), max(o_custkey), round(avg(o_custkey), 4), round(stddev_samp(o_custkey), 4) from sides group by 1""",
)
def quality(spark, d):
    return rounded(D.quality(order_sides(spark, d, "o_totalprice", "o_custkey"), ["o_totalprice", "o_custkey"]), "mean", "std", digits=4)


_TERMS = f"""{_REVIEW}, t as (select side, unnest({TOKENS}) as term from sides),
tc as (select term, count(*) filter (side = 'reference') as n_ref, count(*) filter (side = 'current') as n_cur from t where length(term) >= 2 group by 1)"""


@query(
    "drf_term_divergence",
    f"""with {_TERMS}, p as (select n_ref as a, n_cur as b, n_ref::double / sum(n_ref) over () as p, n_cur::double / sum(n_cur) over () as q,
  (n_ref + 0.5::double) / (sum(n_ref) over () + count(*) over () * 0.5::double) as sp, (n_cur + 0.5::double) / (sum(n_cur) over () + count(*) over () * 0.5::double) as sq from tc)
select round(sqrt(greatest(sum((case when p > 0 then p * ln(p / ((p + q) / 2)) else 0 end + case when q > 0 then q * ln(q / ((p + q) / 2)) else 0 end) / 2) / ln(2.0::double), 0)), 6) as js,
  count(*) as n_values, round(sum(sp * ln(sp / sq)), 6) as kl from p""",
)
def term_divergence(spark, d):
    return rounded(D.divergences(D.term_counts_by_side(_review_sides(spark, d))).select("js", "n_values", "kl"), "js", "kl")


@query("drf_chi_square", f"with {_REVIEW}, {_js_sql('sides', 'domain')} select round(js, 6) as js, round(chi_square, 6) as chi_square, n_values, round(kl, 6) as kl from js")
def chi_square(spark, d):
    return rounded(D.divergences(D.side_counts(_review_sides(spark, d), "domain")), "js", "chi_square", "kl")


@query(
    "drf_oov",
    f"""with {_TERMS} select round(sum(case when n_ref = 0 then n_cur else 0 end) / sum(n_cur), 6) as oov_token_rate,
round(count(*) filter (n_ref = 0 and n_cur > 0) / count(*) filter (n_cur > 0), 6) as oov_term_rate from tc""",
)
def oov(spark, d):
    return rounded(D.oov(D.term_counts_by_side(_review_sides(spark, d))), "oov_token_rate", "oov_term_rate")


@query(
    "drf_prediction_shift",
    f"""with {PRED} select cast(c as integer) as class, round(avg(cast(label = c as integer)), 6) as label_share, round(avg(cast(pred = c as integer)), 6) as pred_share,
round(avg(cast(pred = c as integer)) - avg(cast(label = c as integer)), 6) as shift from pred cross join (values (0), (1)) t(c) group by 1""",
)
def prediction_shift(spark, d):
    return rounded(D.prediction_shift(predictions(spark, d)), "label_share", "pred_share", "shift")
