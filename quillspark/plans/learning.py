"""Queries: linear models, calibration fits, topic models."""

from pyspark.sql import functions as F

from ..operators import balance as B, blocks as BL, calibrate as C, linear as LI, metrics as M, splits as SP, svm as SV, topics as TP
from ..session import stage
from .base import LAB, TOKENS, documents, labelled, query, rank, rounded
from .margins import svm_grid

VOCAB = 5000


def _parts(spark, d):
    parts = SP.stratified_parts(LI.with_tokens(labelled(spark, d))).select("doc_id", "label", "domain", "split", "tokens")
    return stage(parts, "parts")


def _svm(spark, d):
    """A machine with balanced class weights; vocabulary and idf come from the training rows only."""
    parts = _parts(spark, d)
    train = F.col("split") == "train"
    weighted = B.class_weights(parts.where(train)).select("label", F.col("weight").alias("class_weight"))
    rows = stage(parts.join(F.broadcast(weighted), "label", "left"), "weighted")  # a row for each class
    blocks = BL.build(rows, {"m": train.cast("long")}, VOCAB, weights={"m": F.when(train, F.col("class_weight")).otherwise(0.0)})
    return rows, blocks, SV.fit(blocks, max_iter=2000)


def _svm_scored(spark, d):
    rows, blocks, machines = _svm(spark, d)
    m = SV.margins(blocks, machines, ["margin"]).join(rows.select(F.col("doc_id").alias("id"), "label", "split"), "id")
    return m.select(F.col("id").alias("doc_id"), "label", "split", (F.col("margin") > 0).cast("int").alias("pred"), "margin")


@query("mod_linear_svm")
def svm(spark, d):
    return _svm_scored(spark, d).where("split = 'test'").select("doc_id", "label", "pred", "margin")


@query("mod_logistic")
def logistic(spark, d):
    """Logistic regression, run until it converges; the vectorizer sees training rows only."""
    parts = _parts(spark, d)
    vec = LI.fit_vectorizer(parts.where("split = 'train'"), VOCAB)
    v = vec.transform(parts).select("doc_id", "label", "split", "features")
    model = LI.fit_on_cached(LI.logistic(1e-3, 1000, "weight"), B.add_class_weight(v.where("split = 'train'")))
    return model.transform(v.where("split = 'test'")).select("doc_id", "label", F.col("prediction").cast("int").alias("pred"))


@query("mod_svm_report")
def svm_report(spark, d):
    return M.report(_svm_scored(spark, d).where("split = 'test'"))


@query("mod_svm_top_features")
def svm_features(spark, d):
    _, blocks, machines = _svm(spark, d)
    return LI.top_coefficients(SV.coefficients(spark, machines, blocks.scale).where("term is not null").select("term", "weight"))


@query("mod_grid_search")
def grid(spark, d):
    """Cost and iteration grid of the linear SVM over five stratified folds."""
    return svm_grid(spark, d)


def _margins(spark, d):
    m = stage(_svm_scored(spark, d).where("split <> 'train'"), "margins")
    return m.where("split = 'valid'"), m.where("split = 'test'")


@query("cal_platt")
def platt(spark, d):
    valid, test = _margins(spark, d)
    return C.platt_apply(C.platt_fit(valid), test).select("doc_id", "label", "pred", "prob")


@query("cal_ece_before_after")
def before_after(spark, d):
    valid, test = _margins(spark, d)
    before = M.ece(test.withColumn("prob", C.squash(F.col("margin")))).select(F.lit("before").alias("stage"), "ece")
    after = M.ece(C.platt_apply(C.platt_fit(valid), test)).select(F.lit("after").alias("stage"), "ece")
    return before.unionByName(after)


@query("cal_temperature")
def temperature(spark, d):
    valid, test = _margins(spark, d)
    return C.temperature_apply(test, C.temperature_fit(valid)).select("doc_id", "label", "prob")


@query("cal_isotonic")
def isotonic(spark, d):
    valid, test = _margins(spark, d)
    return C.isotonic_apply(C.isotonic_fit(valid), test.withColumn("margin", F.col("margin").cast("double"))).select("doc_id", "label", "prob")


@query("mod_svc_probability")
def svc_probability(spark, d):
    """Linear SVC with a probability: margin, then Platt scaling."""
    valid, test = _margins(spark, d)
    p = C.platt_apply(C.platt_fit(valid), test)
    return p.select("doc_id", "label", "prob", (F.col("prob") > 0.5).cast("int").alias("pred"))


@query("mod_failed_fit", f"""with {LAB}, g as (select domain, source, count(distinct label) as k from lab group by 1, 2)
select doc_id, label, domain, source, case when k < 2 then 'failed' else 'ok' end as status from lab join g on lab.domain is not distinct from g.domain and lab.source is not distinct from g.source""".replace("select doc_id, label, domain, source, case", "select doc_id, label, lab.domain, lab.source, case"))
def failed_fit(spark, d):
    """A machine for every domain and source, fitted together; groups of one class are reported as failed."""
    rows = stage(LI.with_tokens(labelled(spark, d)).select("doc_id", "label", "domain", "source", "tokens"), "groups")
    preds = SV.fit_groups(rows, ["domain", "source"], 1000)
    return preds.select("doc_id", "label", "domain", "source", "status")


# --- topics ---------------------------------------------------------------------------

STOP = ["the", "of", "and", "to", "in", "is", "that"]


def _docs(spark, d):
    return TP.topic_tokens(documents(spark, d).select("doc_id", "text", "domain"), stopwords=STOP)


@query("top_lda_by_label")
def lda_by_label(spark, d):
    """Top words of six topics for each label."""
    out = None
    for lab in (0, 1):
        toks = TP.topic_tokens(labelled(spark, d).where(F.col("label") == lab).select("doc_id", "text"), stopwords=STOP)
        vec, model, _ = TP.fit_lda(toks.select("doc_id", "tokens"), 6, vocab=VOCAB, learn_alpha=False)
        words = TP.topic_words(vec, model)
        one = spark.createDataFrame([(lab, i, r + 1, w) for i, ws in enumerate(words) for r, w in enumerate(ws)], "label int, topic int, rank int, term string")
        out = one if out is None else out.unionByName(one)
    return out


@query("top_topic_table")
def topic_table(spark, d):
    docs = _docs(spark, d)
    vec, model, vectors = TP.fit_lda(docs.select("doc_id", "tokens"), 5, vocab=VOCAB)
    t = TP.topic_table(TP.topic_words(vec, model), TP.topic_distribution(model, vectors), docs)
    return t.withColumn("keywords", F.array_join("keywords", " "))


@query("top_k_sweep")
def k_sweep(spark, d):
    docs = stage(_docs(spark, d).select("doc_id", "tokens"), "topic-tokens")
    return TP.sweep_topics(docs, (5, 10, 15, 20), iterations=10, vocab=VOCAB)


def _lists(spark, d, n=10):
    """The commonest words of five letters or more per domain: fixed lists for coherence."""
    from ..operators.features import token_rows
    from ..operators.ranking import top_n

    rows = token_rows(documents(spark, d), keep=["doc_id", "domain"], min_len=5)
    c = rows.groupBy("domain", "term").agg(F.count_distinct("doc_id").alias("n"))
    top = top_n(c, ["domain"], [F.desc("n"), F.asc("term")], n)
    got = sorted((r["domain"], r["rank"], r["term"]) for r in top.collect())  # ten words per domain
    domains = sorted({g[0] for g in got})
    return [[t for dm, _, t in got if dm == x] for x in domains]


_LISTS = f"""tk as (select doc_id, lang, list_filter({TOKENS}, lambda x: length(x) >= 2 and x not in ({', '.join(f"'{w}'" for w in STOP)})) as ts from documents),
lt as (select lang, t as term, count(distinct doc_id) as n from (select doc_id, lang, unnest({TOKENS}) as t from documents) where length(t) >= 5 group by 1, 2),
wl as (select cast(dense_rank() over (order by lang) - 1 as integer) as topic, cast(r - 1 as integer) as i, term from (select *, row_number() over (partition by lang order by n desc, term) as r from lt) where r <= 10),
tp as (select doc_id, len(ts) as len, unnest(range(0, len(ts))) as pos, unnest(ts) as term from tk where len(ts) > 0)"""


def _coh_sql(window):
    if window:
        ctx = f"select distinct doc_id, unnest(range(greatest(pos - {window - 1}, 0), least(pos, greatest(len - {window}, 0)) + 1)) as s, topic, i from tp join wl using (term)"
        total = f"(select sum(greatest(len(ts) - {window}, 0) + 1) from tk where len(ts) > 0)"
    else:
        ctx = "select distinct doc_id, 0 as s, topic, i from tp join wl using (term)"
        total = "(select count(*) from tk where len(ts) > 0)"
    return f"""{_LISTS}, ctx as ({ctx}), ni as (select topic, i, count(*) as n from ctx group by 1, 2),
nij as (select a.topic, a.i, b.i as j, count(*) as n from ctx a join ctx b on a.doc_id = b.doc_id and a.s = b.s and a.topic = b.topic group by 1, 2, 3),
pr as (select a.topic, a.i, b.i as j, a.n as n_i, b.n as n_j, coalesce(nij.n, 0) as n_ij, {total}::double as n from ni a join ni b on a.topic = b.topic left join nij on nij.topic = a.topic and nij.i = a.i and nij.j = b.i),
pm as (select *, ln((n_ij / n + 1e-12::double) / ((n_i / n) * (n_j / n))) / -ln(n_ij / n + 1e-12::double) as m from pr),
tot as (select topic, j, sum(m) as t from pm group by 1, 2),
cs as (select topic, i, sum(m * t) / (sqrt(sum(m * m)) * sqrt(sum(t * t))) as c from pm join tot using (topic, j) group by 1, 2)"""


@query("top_coherence_cv", f"with {_coh_sql(110)} select topic, round(avg(c), 6) as c_v from cs group by 1")
def coherence_cv(spark, d):
    pairs = TP.pair_counts(_docs(spark, d), _lists(spark, d), window=110)
    return rounded(TP.coherence_cv(pairs), "c_v")


@query(
    "top_coherence_documents",
    f"""with {_coh_sql(None)}, a as (select topic, avg(m) as npmi from pm where i < j group by 1), b as (select topic, avg(ln((n_ij + 1)::double / n_j)) as umass from pr where j < i group by 1)
select topic, round(npmi, 6) as npmi, round(umass, 6) as umass from a join b using (topic)""",
)
def coherence_documents(spark, d):
    pairs = TP.pair_counts(_docs(spark, d), _lists(spark, d), window=None)
    return rounded(TP.coherence_npmi(pairs).join(TP.coherence_umass(pairs), "topic"), "npmi", "umass")


# A topic share table that SQL can also compute: share of each word list in a text.
_LENS = [(2, 3), (4, 5), (6, 8), (9, 99)]
_THETA = f"""tt as (select doc_id, length(t) as n from (select doc_id, unnest({TOKENS}) as t from documents) where length(t) >= 2),
wide as (select doc_id, count(*) as n, {', '.join(f"count(*) filter (n between {a} and {b}) as c{i}" for i, (a, b) in enumerate(_LENS))} from tt group by 1),
theta as ({' union all '.join(f"select doc_id, {i} as topic, c{i} / n as prob from wide" for i in range(len(_LENS)))})"""


def theta(spark, d):
    from ..operators.features import token_rows

    n = F.length("term")
    wide = token_rows(documents(spark, d)).groupBy("doc_id").agg(
        F.count("*").alias("n"), *[F.count_if(n.between(a, b)).alias(f"c{i}") for i, (a, b) in enumerate(_LENS)]
    )
    cells = F.array(*[F.struct(F.lit(i).alias("topic"), (F.col(f"c{i}") / F.col("n")).alias("prob")) for i in range(len(_LENS))])
    return wide.select("doc_id", F.explode(cells).alias("e")).select("doc_id", "e.*")


@query(
    "top_representative_docs",
    f"with {_THETA} select topic, rank, doc_id, round(prob, 6) as prob from (select *, cast(row_number() over (partition by topic order by round(prob, 9) desc, doc_id) as integer) as rank from theta) where rank <= 3",
)
def representative(spark, d):
    return rounded(TP.representative_docs(theta(spark, d)), "prob")


_MAIN = f"{_THETA}, main as (select doc_id, topic from (select *, row_number() over (partition by doc_id order by round(prob, 9) desc, topic) as r from theta) where r = 1)"


@query("top_main_topic", f"with {_MAIN} select doc_id, topic from main")
def main_topic(spark, d):
    return TP.main_topic(theta(spark, d))


@query(
    "top_topic_sentiment",
    f"with {_MAIN} select topic, count(*) filter (quality = 0) as label_0, count(*) filter (quality = 1) as label_1 from main join labels using (doc_id) group by 1",
)
def topic_sentiment(spark, d):
    from .base import gold

    return TP.topic_sentiment(TP.main_topic(theta(spark, d)), gold(spark, d))


@query("top_topic_samples", f"with {_MAIN}, r as (select doc_id, topic, {rank('topic')} as rank from main) select doc_id, topic, rank from r where rank <= 5")
def topic_samples(spark, d):
    return TP.topic_samples(TP.main_topic(theta(spark, d)))
