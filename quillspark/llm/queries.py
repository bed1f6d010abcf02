"""Registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import stage
from . import adaptive_rules, crf, decontaminate, ftrl, importance, mixing, packing, phrases, surrogates, tensor_minhash, va_search, warc, wavelet
from .common import tokenizer_file

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op2_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tensor_minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLES["op2_tensored_minhash"] = r"""
with recursive w as (select doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+') if x <> ''] as ws from documents),
s as (select doc_id, case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
  else list_distinct([array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)]) end as sh from w),
e as (select doc_id, len(sh) as n, unnest(sh) as x from s),
o as (select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as c from e a join e b on a.x = b.x and a.doc_id < b.doc_id group by all),
k as (select a, b from o where 100 * c >= 75 * (na + nb - c)),
g as (select a, b from k union all select b, a from k),
r as (select doc_id, doc_id as node from s union select r.doc_id, g.b from r join g on r.node = g.a),
m as (select doc_id, min(node) as component_id from r group by doc_id)
select s.doc_id, cast(len(sh) as bigint) as n_shingles, component_id, s.doc_id = component_id as kept from s join m using (doc_id)"""


@query
def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


@query
def op4_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = wavelet.write_token_files(table(spark, sf_dir, "documents"), tokenizer_file(), end_id=2)
    n = (F.octet_length("ids") / 4).cast("long")
    return wavelet.read_token_files(files).select("doc_id", "start", n.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query
def op5_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_warc(table(spark, sf_dir, "pages"))
    return warc.records(warc.read_warc(files, with_data=False))


ORACLES["op5_warc_chunks"] = """
with p as (select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as payload_bytes from pages),
q as (select *, min(page_id) over (partition by html) as first from p)
select page_id, cast(payload_bytes as bigint) as payload_bytes, sha256(html) as payload_digest,
  case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first then first end as refers_to from q"""


@query
def op6_va_file_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = va_search.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    rows = rows.select("id", F.transform("v", lambda x: F.floor(x * 256)).alias("v"))
    # Written once: a row keeps its number as query and as candidate, also if its id repeats.
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "va-rows")
    return va_search.topk(rows.where("id % 50 = 0"), rows, k=5, row="row")


ORACLES["op6_va_file_topk"] = """
with v as (select vec_id, [floor(256 * cast(x as double)) for x in embedding] as e from embeddings
  where vec_id is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5"""


def fold(parts: int, held: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == held, F.lit(False))


@query
def op7_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = crf.fit(docs.where(~fold(4, 2)).select("doc_id", "text", "lang"))
    return crf.detect(docs.select("doc_id", fold(4, 2).alias("held_out"), "text"), model)


@query
def op8_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~fold(3, 1)).select("doc_id", F.col("quality").alias("label"))
    scored = ftrl.score(docs, ftrl.fit(docs, labels))
    return scored.select("doc_id", fold(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = adaptive_rules.judge(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLES["op9_adaptive_rules"] = r"""
with t as (select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as text from documents),
w as (select r, [x for x in string_split_regex(text, '[\x20\x09-\x0D]+') if x <> ''] as ws, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as ls from t),
p as (select r, unnest(ws) as w0, unnest(range(len(ws))) as i from w),
g as (select r, i, w0, lead(w0) over o as w1, lead(w0, 2) over o as w2 from p window o as (partition by r order by i)),
d as (select r, i, count(*) over (partition by r, w0, w1, w2) as n from g where w2 is not null),
c as (select r, count(distinct i + k) as n_repeat_words from d, range(3) as s(k) where n >= 2 group by r),
m as (select t.*, cast(len(ws) as bigint) as n_words, cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
  cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, len(ls) as n_lines,
  cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from t join w using (r) left join c using (r)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  [1000 * n_symbols // greatest(word_chars, 1), 1000 * n_repeat_words // greatest(n_words, 1), 1000 * n_dup_lines // greatest(n_lines, 1),
   100 * word_chars // greatest(n_words, 1)] as v from m),
e as (select lang, source, unnest([1, 2, 3, 4]) as k, unnest(v) as x from f where not base_failed),
b as (select lang, source, k, (x >> greatest(length(bin(x)) - 8, 0)) << greatest(length(bin(x)) - 8, 0) as x from e),
l as (select 1 as level, lang, source, k, x from b union all select 2, lang, null, k, x from b union all select 3, null, null, k, x from b),
u as (select level, lang, source, k, x, sum(count(*)) over (partition by level, lang, source, k order by x) as upto, sum(count(*)) over (partition by level, lang, source, k) as n
  from l group by level, lang, source, k, x),
q as (select level, lang, source, k, max(n) as n, min(x) filter (where upto * 4 >= n) as q1, min(x) filter (where upto * 4 >= n * 3) as q3 from u group by level, lang, source, k),
h as (select *, case when k = 4 then q1 - 3 * greatest(q3 - q1, 60) else 0 end as lo, q3 + 3 * greatest(q3 - q1, [20, 100, 200, 60][k]) as hi from q),
j as (select a.lang, a.source, a.k, case when a.n >= 200 then a.lo when b.n >= 200 then b.lo else c.lo end as lo, case when a.n >= 200 then a.hi when b.n >= 200 then b.hi else c.hi end as hi
  from h a join h b on a.level = 1 and b.level = 2 and a.k = b.k and a.lang is not distinct from b.lang join h c on c.level = 3 and c.k = a.k),
z as (select r, bool_and(v[k] between lo and hi) as inside from f join j on f.lang is not distinct from j.lang and f.source is not distinct from j.source group by r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce(inside, false) as kept from f left join z using (r)"""


@query
def op10_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placements, _ = packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file())
    return placements.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op11_prefix_filter_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return got.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


_LETTERS = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LETTERS}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op11_prefix_filter_decontamination"] = f"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as ws from documents),
i as (select item_id, {_WORDS} as ws from benchmark),
w as (select distinct item_id, case when len(ws) < 10 then ws else ws[k:k + 9] end as win from i, lateral (select unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as k) where len(ws) > 0),
n as (select distinct len(win) as size from w),
p as (select r, k, size, ws[k:k + size - 1] as win from d, n, lateral (select unnest(range(1, greatest(len(ws) - size + 1, 0) + 1)) as k)),
o as (select r, k, size, item_id from p join w using (win)),
h as (select r, count(distinct k + j) as n_hit from o, lateral (select unnest(range(size)) as j) group by r),
m as (select r, count(distinct item_id) as n_items, array_to_string(list_sort(list_distinct(list(cast(item_id as varchar)))), ',') as items from o group by r)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (r) left join m using (r)"""


@query
def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_features", "weight", "score", "rank")


# SQL has no CRC-32: eight steps for each bit of each byte of the distinct words
_CRC_STEP = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
ORACLES["op12_target_resampling"] = f"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as ws from documents),
x as (select r, unnest(ws) as word from d),
y as (select unnest({_WORDS}) as word from benchmark),
u as (select distinct word, hex(encode(word)) as code from (select word from x union select word from y)),
t0 as (select range as b, cast(range as bigint) as c from range(256)),
t1 as (select b, {_CRC_STEP} as c from t0), t2 as (select b, {_CRC_STEP} as c from t1), t3 as (select b, {_CRC_STEP} as c from t2),
t4 as (select b, {_CRC_STEP} as c from t3), t5 as (select b, {_CRC_STEP} as c from t4), t6 as (select b, {_CRC_STEP} as c from t5),
t7 as (select b, {_CRC_STEP} as c from t6), t8 as (select b, {_CRC_STEP} as c from t7),
tab as (select list(c order by b) as tab from t8),
crc as (select word, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(cast(length(code) / 2 as bigint)), lambda j: cast(concat('0x', substr(code, 2 * j + 1, 2)) as bigint))),
  lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket from u, tab),
s as (select bucket, count(*) as s from x join crc using (word) group by 1),
t as (select bucket, count(*) as t from y join crc using (word) group by 1),
g as (select range as bucket, cast(floor(1000 * ln((coalesce(t, 0) + 1.0::double) * ((select count(*) from x) + 10000.0::double)
  / ((coalesce(s, 0) + 1.0::double) * ((select count(*) from y) + 10000.0::double)))) as bigint) as gain
  from range(10000) left join s on s.bucket = range left join t on t.bucket = range),
w as (select r, sum(gain) as weight from x join crc using (word) join g using (bucket) group by r),
f as (select r, doc_id, cast(len(ws) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
  cast(concat('0x', substr(sha256(concat('2024:', cast(doc_id as varchar))), 1, 8)) as bigint) as h from d left join w using (r)),
c as (select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296.0::double))) as bigint) as score from f),
k as (select r, row_number() over (order by score desc, doc_id) as rank from c where n_features >= 20)
select doc_id, n_features, weight, score, case when rank <= (select 10 * count(*) // 100 from c where n_features >= 20) then rank end as rank
from c left join k using (r)"""


@query
def op13_toivonen_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = phrases.collocations(table(spark, sf_dir, "documents"))
    return got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLES["op13_toivonen_collocations"] = rf"""
with p as (select coalesce(lang, 'und') as lang, unnest(string_split_regex({_LETTERS}, '[.,;:!?
-
]')) as piece from documents),
w as (select row_number() over () as id, lang, [x for x in string_split_regex(piece, '[ 	]+') if x <> ''] as ws from p),
e as (select id, lang, unnest(ws) as w0, unnest(range(len(ws))) as i from w),
g as (select lang, w0, lead(w0) over o as w1, lead(w0, 2) over o as w2 from e window o as (partition by id order by i)),
f1 as (select lang, w0 as phrase, count(*) as f from g group by 1, 2),
f2 as (select lang, concat(w0, ' ', w1) as phrase, w0, w1, count(*) as f from g where w1 is not null group by all having count(*) >= 10),
f3 as (select lang, concat(w0, ' ', w1, ' ', w2) as phrase, w0, w1, w2, count(*) as f from g where w2 is not null group by all having count(*) >= 10),
n as (select lang, count(*) as n from e group by 1),
c as (select lang, phrase, f as a, 1 as k, w0 as lp, w1 as rp from f2 union all select lang, phrase, f, 1, w0, concat(w1, ' ', w2) from f3
  union all select lang, phrase, f, 2, concat(w0, ' ', w1), w2 from f3),
f as (select lang, phrase, f from f1 union all select lang, phrase, f from f2),
s as (select c.*, x.f as l, y.f as r, cast((1000000::hugeint * a * a) // (x.f::hugeint * y.f) as bigint) as score
  from c join f x on x.lang = c.lang and x.phrase = lp join f y on y.lang = c.lang and y.phrase = rp),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
m as (select lang, phrase, max(f) as most from (select lang, concat(w0, ' ', w1) as phrase, f from f3 union all select lang, concat(w1, ' ', w2), f from f3) group by all),
q as (select b.lang, b.phrase, a, l, r, n, score from b join n using (lang) left join m on m.lang = b.lang and m.phrase = b.phrase where most is null or 100 * most < 50 * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from q
qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= 2000"""
