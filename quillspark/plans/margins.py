"""Queries: term selection over word pairs, TF-IDF Naive Bayes and support vector machines, all models in the same passes."""

from pyspark.sql import Window, functions as F

from ..functions.text import ngrams_1_2, tokenize
from ..operators import balance as B, bayes as NB, blocks as BL, features as FE, metrics as M, splits as SP, svm as SV, tfidf_bayes as TB
from ..operators.vocabulary import top_terms
from ..session import stage
from .base import LAB, TOKENS, documents, labelled, query, rounded
from .models import _BAL, _R, _SPLIT, VOCAB, _domains

ALPHAS = (0.1, 0.5, 1.0, 2.0)
COSTS, ITERATIONS = (0.1, 1.0, 5.0, 10.0), (1000, 3000)
CV_VOCAB = 20_000
TOLERANCE = 1e-4


def with_terms(df, pairs=True):
    """Adds ``tokens``: words of two letters and more, and neighbours joined by a space."""
    out = df.withColumn("tokens", tokenize(F.col("text"), (), 2))
    return out.withColumn("tokens", ngrams_1_2(F.col("tokens"))) if pairs else out


def _words(text="text"):
    return f"list_filter({TOKENS.replace('text', text)}, lambda x: length(x) >= 2)"


def _terms(pairs):
    return "list_concat(ws, list_transform(range(1, len(ws)), lambda i: concat(ws[i], ' ', ws[i + 1])))" if pairs else "ws"


_GRAMS = f"gw as (select doc_id, lang as domain, {_words()} as ws from documents), gt as (select doc_id, domain, unnest({_terms(True)}) as term from gw)"


@query(
    "fea_top_terms",
    f"""with {_GRAMS}, c as (select domain as model, term, count(*) as cnt, count(distinct doc_id) as df from gt group by 1, 2)
select model, cast(row_number() over (partition by model order by cnt desc, term) as integer) as rank, term, cnt, df from c
qualify row_number() over (partition by model order by cnt desc, term) <= {VOCAB}""",
)
def top(spark, d):
    """The commonest words and word pairs of every domain."""
    docs = documents(spark, d)
    found = sorted(r["domain"] for r in docs.where("domain is not null").select("domain").distinct().collect())  # a model each
    weights = {f"m{i}": F.col("domain").eqNullSafe(F.lit(x)).cast("long") for i, x in enumerate(found)}
    got = top_terms(with_terms(docs), weights, VOCAB)
    name = F.element_at(F.array(*[F.lit(x) for x in found]), F.substring("model", 2, 9).cast("int") + 1)
    return got.select(name.alias("model"), "rank", "term", "cnt", "df")


# --- TF-IDF Naive Bayes ----------------------------------------------------------------------


def tfidf_nb_sql(train, weight, test, keys="", vocab=VOCAB, pairs=False, alphas="(values (1.0::double)) al(alpha)", name="tn"):
    """Scores of TF-IDF Naive Bayes for each model (``keys``) and alpha."""
    k = f"{keys}, " if keys else ""
    part = f"partition by {keys}" if keys else ""
    using = f"({k}term)"
    join = lambda other: f"join {other} using ({keys})" if keys else f"cross join {other}"
    return f"""{name}_a as (select {k}doc_id, label, {weight} as w, unnest({_terms(pairs)}) as term from (select *, {_words()} as ws from {train})),
{name}_b as (select {k}doc_id, label, w, term, count(*) as tf from {name}_a where w > 0 group by all),
{name}_n as (select {k}cast(sum({weight}) as double) as n, sum(case when label = 0 then {weight} else 0 end) as n0, sum(case when label = 1 then {weight} else 0 end) as n1 from {train} {('group by ' + keys) if keys else ''}),
{name}_v as (select {k}term, sum(w) as df, sum(w * tf) as cnt from {name}_b group by {k}term qualify row_number() over ({part} order by sum(w * tf) desc, term) <= {vocab}),
{name}_i as (select {k}term, ln((1 + n) / (1 + df)) + 1 as idf from {name}_v {join(name + '_n')}),
{name}_x as (select *, tf * idf / sqrt(sum(tf * idf * tf * idf) over (partition by {k}doc_id)) as x from {name}_b join {name}_i using {using}),
{name}_c as (select {k}term, sum(case when label = 0 then w * x else 0 end) as f0, sum(case when label = 1 then w * x else 0 end) as f1 from {name}_x group by {k}term),
{name}_l as (select {k}term, alpha, ln((f0 + alpha) / (sum(f0) over (partition by {k}alpha) + alpha * count(*) over (partition by {k}alpha))) as l0,
  ln((f1 + alpha) / (sum(f1) over (partition by {k}alpha) + alpha * count(*) over (partition by {k}alpha))) as l1 from {name}_c, {alphas}),
{name}_d as (select {k}doc_id, term, count(*) as tf from (select {k}doc_id, unnest({_terms(pairs)}) as term from (select *, {_words()} as ws from {test})) group by all),
{name}_y as (select *, tf * idf / sqrt(sum(tf * idf * tf * idf) over (partition by {k}doc_id)) as x from {name}_d join {name}_i using {using}),
{name}_s as (select {k}doc_id, alpha, sum(x * l0) as t0, sum(x * l1) as t1 from {name}_y join {name}_l using {using} group by {k}doc_id, alpha),
{name} as (select t.* exclude (text), al.alpha, ln(n0 / n) + coalesce(t0, 0) as s0, ln(n1 / n) + coalesce(t1, 0) as s1 from {test} t cross join {alphas} {join(name + '_n')} left join {name}_s s on s.doc_id = t.doc_id and s.alpha = al.alpha {f'and s.{keys} = t.{keys}' if keys else ''}),
{name}_p as (select *, cast(s1 > s0 as integer) as pred from {name})"""


_HOLD = f"{_SPLIT}, {_BAL}, tex as (select doc_id, label, text from sp where split = 'test')"


def _holdout_blocks(spark, d, pairs):
    parts = stage(SP.stratified_holdout(with_terms(labelled(spark, d), pairs)).select("doc_id", "label", "split", "tokens"), "parts")
    copies = B.copies_to_majority(parts.where("split = 'train'")).select("doc_id", "copies")
    rows = stage(parts.join(copies, "doc_id", "left"), "parts")  # the test rows have no copies
    return BL.build(rows, {"m": F.coalesce("copies", F.lit(0))}, VOCAB), rows


def _nb_tfidf(spark, d, pairs):
    blocks, rows = _holdout_blocks(spark, d, pairs)
    scored = TB.score(blocks, TB.fit(blocks)).join(rows.where("split = 'test'").select(F.col("doc_id").alias("id")), "id", "left_semi")
    s0, s1 = F.col("s_m_0_0"), F.col("s_m_0_1")
    return rounded(scored.select(F.col("id").alias("doc_id"), F.col("y").cast("int").alias("label"), s0.alias("s0"), s1.alias("s1"), TB.predicted(s0, s1).alias("pred")), "s0", "s1")


def _nb_sql(pairs):
    return f"with {_HOLD}, {tfidf_nb_sql('trw', 'copies', 'tex', pairs=pairs)} select doc_id, label, round(s0, 6) as s0, round(s1, 6) as s1, pred from tn_p"


@query("mod_nb_tfidf", _nb_sql(False))
def nb_tfidf(spark, d):
    """Naive Bayes on TF-IDF weights of words, fitted on the balanced training rows."""
    return _nb_tfidf(spark, d, False)


@query("mod_nb_bigrams", _nb_sql(True))
def nb_bigrams(spark, d):
    """The same on words and word pairs."""
    return _nb_tfidf(spark, d, True)


def _folds(spark, d, k=5, pairs=False):
    docs = with_terms(labelled(spark, d), pairs).select("doc_id", "label", "domain", "tokens")
    return stage(SP.stratified_folds(docs, k), "folds")


def fold_weighted_f1(preds, keys):
    """Weighted F1 per fold, then mean and deviation over the folds, by ``keys``."""
    per = M.summary(preds, [*keys, "fold"])
    return per.groupBy(*keys).agg(F.avg("weighted_f1").alias("f1"), F.stddev_pop("weighted_f1").alias("f1_std"))


_GRID = f"""{LAB}, {_R}, fo as (select doc_id, label, text, cast((rk - 1) % 5 as integer) as fold from r),
ga as (select fo.*, h.held, cast(fo.fold <> h.held as integer) as w from fo cross join (select unnest(range(0, 5)) as held) h),
tex as (select doc_id, label, text, fold, cast(fold as bigint) as held from fo),
{tfidf_nb_sql('ga', 'w', 'tex', keys='held', alphas='(values ' + ', '.join(f'({a}::double)' for a in ALPHAS) + ') al(alpha)')},
gc as (select alpha, fold, c, count(*) filter (label = c) as support, count(*) filter (label = c and pred = c) as tp, count(*) filter ((label = c) <> (pred = c)) as err from tn_p cross join (values (0), (1)) z(c) group by all),
gf as (select alpha, fold, sum(support * case when 2 * tp + err = 0 then 0.0::double else 2 * tp / (2 * tp + err) end) / sum(support) as f from gc group by all),
gm as (select alpha, round(avg(f), 6) as f1, round(stddev_pop(f), 6) as f1_std from gf group by 1)"""


@query("mod_nb_grid", f"with {_GRID} select alpha, f1, f1_std, row_number() over (order by f1 desc, alpha) = 1 as best from gm")
def nb_grid(spark, d):
    """Weighted F1 of each smoothing over five folds; vocabulary and idf are those of the training folds."""
    rows = _folds(spark, d)
    blocks = BL.build(rows, {f"f{i}": (F.col("fold") != i).cast("long") for i in range(5)}, VOCAB)
    scored = TB.score(blocks, TB.fit(blocks), ALPHAS).join(rows.select(F.col("doc_id").alias("id"), "fold"), "id")
    cells = []
    for a, alpha in enumerate(ALPHAS):
        own = F.coalesce(*[F.when(F.col("fold") == i, TB.predicted(F.col(f"s_f{i}_{a}_0"), F.col(f"s_f{i}_{a}_1"))) for i in range(5)])
        cells.append(F.struct(F.lit(alpha).alias("alpha"), own.alias("pred")))
    preds = scored.select(F.col("y").alias("label"), "fold", F.explode(F.array(*cells)).alias("c")).select("label", "fold", "c.*")
    return _with_best(rounded(fold_weighted_f1(preds, ["alpha"]), "f1", "f1_std"), ["alpha"])


def _with_best(table_, keys):
    best = table_.orderBy(F.desc("f1"), *keys).limit(1).select(F.struct(*keys).alias("k"))
    return table_.withColumn("best", F.struct(*keys) == best.scalar())


# --- support vector machines ------------------------------------------------------------------


def _balanced(rows, names):
    """Balanced class weights of each model: copies times n / (2 n_c)."""
    sums = rows.groupBy("label").agg(*[F.sum(n).alias(n) for n in names]).collect()  # a row for each class
    out = {}
    for n in names:
        size = {r["label"]: r[n] or 0 for r in sums}
        out[n] = F.col(n) * F.coalesce(*[F.when(F.col("label") == c, F.lit(sum(size.values()) / (2.0 * s))) for c, s in size.items() if s] or [F.lit(0.0)])
    return out


def _svm_folds(spark, d, k=5):
    """Machines of all folds, each trained on its balanced training part, and the rows with their fold."""
    names = [f"f{i}" for i in range(k)]
    docs = with_terms(labelled(spark, d), False)
    plan = NB.fold_copies(docs, k)
    rows = stage(docs.select("doc_id", "label", "domain", "tokens").join(plan.select("doc_id", "fold", *[F.col(f"_c{i}").alias(f"f{i}") for i in range(k)]), "doc_id"), "svm-folds")
    weights = _balanced(rows, names)
    blocks = BL.build(rows, {n: F.col(n) for n in names}, CV_VOCAB, weights=weights)
    return rows, weights, blocks, SV.fit(blocks, tolerance=TOLERANCE, max_iter=10_000)


@query("mod_svm_cross_validation")
def svm_cross_validation(spark, d):
    """Out-of-fold margins and classes of five machines fitted together."""
    rows, _, blocks, machines = _svm_folds(spark, d)
    scored = SV.margins(blocks, machines, machines.models).join(rows.select(F.col("doc_id").alias("id"), "fold", "label"), "id")
    margin = F.coalesce(*[F.when(F.col("fold") == i, F.col(f"f{i}")) for i in range(5)])
    out = scored.select(F.col("id").alias("doc_id"), "fold", "label", margin.alias("margin"))
    return out.withColumn("pred", (F.col("margin") > 0).cast("int"))


@query("met_svm_fold_metrics")
def svm_fold_metrics(spark, d):
    return M.binary(svm_cross_validation(spark, d), ["fold"])


_CV_SIZES = f"""{LAB}, {_R}, fo as (select doc_id, label, cast((rk - 1) % 5 as integer) as fold from r),
tr0 as (select fo.*, h.held from fo join (select unnest(range(0, 5)) as held) h on fo.fold <> h.held),
sz as (select held, label, count(*) as n from tr0 group by 1, 2), m as (select held, max(n) as mx, min(n) as mn from sz group by 1)"""


@query(
    "mod_svm_optimality",
    f"""with {_CV_SIZES} select concat('f', held) as model, cast(sum(case when mn < greatest(5.0, mx * 0.2::double) then mx else n end) as bigint) as n_train, true as optimal
from sz join m using (held) group by 1""",
)
def svm_optimality(spark, d):
    """Are the stored weights the optimum? The gradient of each model's objective, by joins on the coefficient table."""
    rows, weights, blocks, machines = _svm_folds(spark, d)
    names = machines.models
    kept = stage(SV.coefficients(spark, machines, blocks.scale), "coefficients")
    at = {n: i for i, n in enumerate(names)}
    idf = stage(spark.createDataFrame([(n, t, float(blocks.scale[at[n], j])) for n in names for j, t in enumerate(blocks.terms) if blocks.scale[at[n], j] > 0], "model string, term string, idf double"), "idf")

    def by_model(table_, value):
        return table_.groupBy("term").agg(*[F.max(F.when(F.col("model") == n, F.col(value))).alias(f"{value}_{n}") for n in names])

    wide = F.broadcast(by_model(kept, "weight").join(by_model(idf, "idf"), "term", "left"))  # a row for each term of the capped vocabularies
    # the rows of a document stay together: its cells are counted, joined, summed and spread without another shuffle; a null term is the bias
    y = 2.0 * F.col("label") - 1.0
    pulls0 = [F.when(F.col(n) > 0, -2.0 * weights[n] * y).alias(f"pull0_{n}") for n in names]
    with_bias = F.array_append(F.coalesce("tokens", F.array().cast("array<string>")), F.lit(None))
    docs = rows.select(F.monotonically_increasing_id().alias("row"), with_bias.alias("tokens"), y.alias("y"), *pulls0)
    keys = ["row", "y", *[f"pull0_{n}" for n in names]]
    docs = docs.where(F.coalesce(*keys[2:]).isNotNull())
    tf = docs.repartition("row").select(*keys, F.explode("tokens").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))
    cells = tf.join(wide.withColumnRenamed("term", "known"), F.col("term").eqNullSafe(F.col("known")))
    cells = cells.withColumns({f"v_{n}": F.col("tf") * F.col(f"idf_{n}") for n in names})
    sums, of_term = {}, []
    for n in names:
        v, weight = F.col(f"v_{n}"), F.col(f"weight_{n}")
        sums |= {f"norm_{n}": F.sqrt(F.sum(v * v).over(Window.partitionBy("row"))), f"vw_{n}": F.sum(v * weight).over(Window.partitionBy("row"))}
        sums[f"bias_{n}"] = F.max(F.when(F.col("term").isNull(), weight)).over(Window.partitionBy("row"))
    cells = cells.withColumns(sums)
    for n in names:
        margin = F.coalesce(F.col(f"vw_{n}") / F.col(f"norm_{n}"), F.lit(0.0)) + F.col(f"bias_{n}")
        x = F.when(F.col("term").isNull(), F.lit(1.0)).otherwise(F.col(f"v_{n}") / F.col(f"norm_{n}"))
        pull0 = F.col(f"pull0_{n}")
        of_term += [F.sum(pull0 * F.greatest(F.lit(0.0), 1.0 - F.col("y") * margin) * x).alias(f"g_{n}"), F.sum(pull0 * x).alias(f"g0_{n}"), F.first(f"weight_{n}").alias(f"weight_{n}")]
    g = cells.groupBy("term").agg(*of_term)
    norms = g.agg(*[F.struct(F.sqrt(F.sum((F.col(f"g_{n}") + F.col(f"weight_{n}")) ** 2)).alias("end"), F.sqrt(F.sum(F.col(f"g0_{n}") ** 2)).alias("start")).alias(n) for n in names])
    norms = norms.select(F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"{n}.end").alias("end"), F.col(f"{n}.start").alias("start")) for n in names])).alias("m")).select("m.*")
    sizes = rows.agg(*[F.sum(F.when(F.col(n) > 0, F.col(n))).alias(n) for n in names])
    sizes = sizes.select(F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(n).alias("n_train")) for n in names])).alias("m")).select("m.*").where("n_train is not null")
    return sizes.join(norms, "model").select("model", "n_train", (F.col("end") <= 2 * TOLERANCE * F.col("start")).alias("optimal"))


def transfer_margins(spark, d):
    """Margins of the machine of every source domain on every document."""
    found = _domains(spark, d)
    rows = stage(with_terms(labelled(spark, d)).select("doc_id", "label", "domain", "tokens"), "transfer")
    names = [f"m{i}" for i in range(len(found))]
    blocks = BL.build(rows, {n: F.col("domain").eqNullSafe(F.lit(x)).cast("long") for n, x in zip(names, found)}, VOCAB)
    machines = SV.fit(blocks, tolerance=TOLERANCE, max_iter=2000)
    scored = SV.margins(blocks, machines, names).join(rows.select(F.col("doc_id").alias("id"), "domain"), "id")
    cells = F.explode(F.array(*[F.struct(F.lit(x).alias("source"), F.col(n).alias("margin")) for n, x in zip(names, found)])).alias("m")
    out = scored.select(F.col("id").alias("doc_id"), F.col("y").cast("int").alias("label"), F.col("domain").alias("target"), cells)
    return out.select("doc_id", "m.source", "target", "label", "m.margin", (F.col("m.margin") > 0).cast("int").alias("pred"))


@query("mod_svm_transfer")
def svm_transfer(spark, d):
    return transfer_margins(spark, d)


@query("met_transfer_svm")
def transfer_svm(spark, d):
    """Source by target table of the machines on words and word pairs, one fit for all sources."""
    return M.with_retention(M.summary(transfer_margins(spark, d).where("target is not null"), ["source", "target"]))


def svm_grid(spark, d):
    """Cost x iterations: one machine for each cost and fold, all in the same passes.

    The fit stops at its optimum, so two limits give the same machine unless
    the smaller one is reached; ``iterations`` says how many steps it took.
    """
    rows = _folds(spark, d)
    blocks = BL.build(rows, {f"f{i}": (F.col("fold") != i).cast("long") for i in range(5)}, VOCAB)
    of = [i for i in range(5) for _ in COSTS]
    out = None
    for limit in ITERATIONS:
        if out is None or (machines.steps >= prior_limit).any():
            machines = SV.fit(blocks, list(COSTS) * 5, of=of, tolerance=TOLERANCE, max_iter=limit)
            names = [f"f{m}_{c}" for m in range(5) for c in range(len(COSTS))]
            scored = SV.margins(blocks, machines, names, of=of).join(rows.select(F.col("doc_id").alias("id"), "fold"), "id")
            cells = []
            for c, cost in enumerate(COSTS):
                own = F.coalesce(*[F.when(F.col("fold") == i, F.col(f"f{i}_{c}")) for i in range(5)])
                cells.append(F.struct(F.lit(cost).alias("cost"), (own > 0).cast("int").alias("pred")))
            preds = scored.select(F.col("y").alias("label"), "fold", F.explode(F.array(*cells)).alias("c")).select("label", "fold", "c.*")
            table_ = stage(fold_weighted_f1(preds, ["cost"]), "grid")
        prior_limit = limit
        one = table_.withColumn("max_iter", F.lit(limit))
        out = one if out is None else out.unionByName(one)
    return _with_best(out.select("cost", "max_iter", "f1", "f1_std"), ["cost", "max_iter"])
