"""Queries: augmentation."""

from pyspark.sql import functions as F

from ..functions import augment as A
from ..functions.hashing import hash_key
from ..operators import augmentation as AU, sampling as S
from .base import LAB, documents, h, hint, labelled, query, rank, rounded
from .models import nb_sql

SYN = {"the": ["this", "a"], "of": ["from", "by", "off"], "und": ["oder", "auch"], "de": ["du", "des"]}
TYPOS = [("tion", "toin"), ("ich", "ihc"), ("th", "ht")]
EMOJIS = [("trash", "👎"), ("thing", "👍"), ("elle", "😊")]
REWRITES = [("(.*)( the | of )(.*)", "$1$3$2"), ("!!", "."), ("and ", "")]
CHARS = {"q": ["k", "kw"], "z": ["s", "ts"]}
CHAR_TYPOS = {"y": ["j"], "w": ["v", "vv"]}



def _s(x):
    return f"'{x}'"


def _draw(key, n):
    return f"({hint(key)} % ({n}))"


def _chance(key, p):
    return f"({_draw(key, 10000)} < {round(p * 10000)})"


# Segments are numbered from 0; lists in the checks count from 1.
_SEG = "regexp_extract_all(text, '([^\\s]+\\s*|\\s+)', 1)"
_BASE = f"k as (select doc_id, text, {h()} as key, {_SEG} as segs from documents)"


def _key(key, *parts):
    return "md5(concat_ws(':', " + ", ".join([key, *parts]) + "))"


def rd_sql(key="key", segs="segs", p=0.1):
    kept = f"list_filter(list_zip({segs}, range(0, len({segs}))), lambda z: not {_chance(_key(key, _s('rd'), 'cast(z[2] as varchar)'), p)})"
    one = f"{segs}[cast({_draw(_key(key, _s('rd-keep')), f'len({segs})')} + 1 as integer)]"
    return f"case when len({segs}) <= 1 then array_to_string({segs}, '') when len({kept}) = 0 then {one} else array_to_string(list_transform({kept}, lambda z: z[1]), '') end"


def rs_sql(key="key", segs="segs"):
    a = _draw(_key(key, _s("rs-a"), _s("0")), f"len({segs})")
    b0 = _draw(_key(key, _s("rs-b"), _s("0")), f"greatest(len({segs}) - 1, 1)")
    b = f"(case when {b0} >= {a} then {b0} + 1 else {b0} end)"
    return (
        f"case when len({segs}) < 2 then array_to_string({segs}, '') else array_to_string(list_transform(list_zip({segs}, range(0, len({segs}))), "
        f"lambda z: case when z[2] = {a} then {segs}[{b} + 1] when z[2] = {b} then {segs}[{a} + 1] else z[1] end), '') end"
    )


def syn_sql(key="key", segs="segs", p=0.1):
    i = "cast(z[2] as varchar)"
    cases = " ".join(
        f"when rtrim(z[1], ' ') = '{w}' and {_chance(_key(key, _s('syn'), i), p)} then concat([{', '.join(map(_s, o))}][{_draw(_key(key, _s('syn-pick'), i), len(o))} + 1], substr(z[1], {len(w) + 1}))"
        for w, o in SYN.items()
    )
    return f"array_to_string(list_transform(list_zip({segs}, range(0, len({segs}))), lambda z: case {cases} else z[1] end), '')"


def typo_sql(key="key", p=0.1):
    return "case " + " ".join(
        f"when contains(text, '{s}') and {_chance(_key(key, _s('typo'), _s(j)), p)} then concat(left(text, instr(text, '{s}') - 1), '{t}', substr(text, instr(text, '{s}') + {len(s)}))"
        for j, (s, t) in enumerate(TYPOS)
    ) + " else text end"


def emoji_sql(key="key", p=0.3):
    return "case " + " ".join(
        f"when contains(text, '{w}') and {_chance(_key(key, _s('emoji'), _s(j)), p)} then concat(text, '{e}')" for j, (w, e) in enumerate(EMOJIS)
    ) + " else text end"


def bt_sql(key="key", p=0.3):
    out = "text"
    for j, (pat, rep) in enumerate(REWRITES):
        rep = rep.replace("$", "\\")
        out = f"(case when {_chance(_key(key, _s('bt'), _s(j)), p)} then regexp_replace({out}, '{pat}', '{rep}', 'g') else {out} end)"
    return out


def _keyed(spark, d):
    return documents(spark, d).select("doc_id", "text", A.segments(F.col("text")).alias("segs"), hash_key("doc_id", 42).alias("key"))


_OPS = {
    "aug_random_deletion": (rd_sql(), lambda t, s, k: A.random_deletion(s, k)),
    "aug_random_swap": (rs_sql(), lambda t, s, k: A.random_swap(s, k)),
    "aug_synonym": (syn_sql(), lambda t, s, k: A.synonym_replace(s, k, SYN)),
    "aug_typo": (typo_sql(), lambda t, s, k: A.add_typo(t, k, TYPOS)),
    "aug_emoji": (emoji_sql(), lambda t, s, k: A.add_emoji(t, k, EMOJIS)),
    "aug_rewrite": (bt_sql(), lambda t, s, k: A.rewrite(t, k, REWRITES)),
}
for _n, (_sql, _fn) in _OPS.items():
    query(_n, f"with {_BASE} select doc_id, {_sql} as aug_text from k")(
        lambda spark, d, f=_fn: _keyed(spark, d).select("doc_id", f(F.col("text"), F.col("segs"), F.col("key")).alias("aug_text"))
    )

METHODS = ["rd", "rs", "synonym", "typo", "emoji", "backtrans"]
_TABLES = dict(synonyms=SYN, typos=TYPOS, emojis=EMOJIS, rewrites=REWRITES)


def variants_sql(src, methods, n=3):
    sql = {"rd": rd_sql(), "rs": rs_sql(), "synonym": syn_sql(p=0.15), "typo": typo_sql(), "emoji": emoji_sql(), "backtrans": bt_sql()}
    pick = _draw(_key("key", _s("op")), len(methods))
    return f"""vk as (select s.*, c as copy, {_key(h(), 'cast(c as varchar)')} as key, {_SEG} as segs from {src} s cross join (select unnest(range(1, {n + 1})) as c)),
va as (select *, case {pick} {" ".join(f"when {i} then {sql[m]}" for i, m in enumerate(methods))} end as aug_text from vk)"""


_OK = "aug_text <> text and length(aug_text) >= (1 - 0.2::double) * length(text) and length(aug_text) <= (1 + 0.2::double) * length(text)"


@query("aug_pick_operation", f"with src as (select doc_id, text from documents), {variants_sql('src', METHODS)} select doc_id, cast(copy as integer) as copy, aug_text from va")
def pick_operation(spark, d):
    return AU.variants(documents(spark, d).select("doc_id", "text"), 3, METHODS, **_TABLES).select("doc_id", "copy", "aug_text")


@query(
    "aug_table",
    f"""with {LAB}, {variants_sql('lab', METHODS)} select doc_id, label, text, origin from lab cross join (values ('original-1'), ('original-2')) o(origin)
union all select doc_id, label, aug_text, concat('variant-', copy) from va where {_OK}""",
)
def aug_table(spark, d):
    lab = labelled(spark, d).select("doc_id", "label", "text")
    return AU.augment_table(lab, 3, METHODS, **_TABLES).select("doc_id", "label", "text", "origin")


def _chars_sql(text, key, table, p):
    i = "cast(z[2] as varchar)"
    cases = " ".join(
        f"when z[1] = '{w}' and {_chance(_key(key, _s('ch'), i), p)} then [{', '.join(map(_s, o))}][{_draw(_key(key, _s('ch-pick'), i), len(o))} + 1]"
        for w, o in table.items()
    )
    return f"array_to_string(list_transform(list_zip(string_split({text}, ''), range(0, length({text}))), lambda z: case {cases} else z[1] end), '')"


@query(
    "aug_chain",
    f"""with a as (select doc_id, {_chars_sql('text', _key(h(), _s('synonym')), CHARS, 0.1)} as t from documents),
b as (select doc_id, regexp_replace(regexp_replace(t, '[#]', 'hash', 'g'), '[$%]', 'sign', 'g') as t from a)
select doc_id, {_chars_sql('t', _key(h(), _s('typo')), CHAR_TYPOS, 0.05)} as aug_text from b""",
)
def chain(spark, d):
    df = documents(spark, d).select("doc_id", "text")
    return AU.chain(df, synonyms=CHARS, typos=CHAR_TYPOS, emoji=[("[#]", "hash"), ("[$%]", "sign")]).select("doc_id", "aug_text")


_LOW = ["rd", "rs", "synonym"]


@query(
    "aug_low_resource",
    f"""with {LAB}, r as (select *, {rank('label')} as rk from lab), train as (select doc_id, label, text from r where rk <= 30), te0 as (select doc_id, label, text from lab where doc_id not in (select doc_id from train)),
{variants_sql('train', _LOW)}, trw as (select 'base' as setting, label, text, 1 as copies from train union all select 'aug', label, text, 1 from train cross join (values (1), (2)) o(x)
  union all select 'aug', label, aug_text, 1 from va where {_OK}),
tex as (select te0.*, setting from te0 cross join (values ('base'), ('aug')) s(setting)), {nb_sql(test='tex', keys='setting', vocab=3000)},
c as (select setting, c, count(*) filter (label = c and pred = c) as tp, count(*) filter ((label = c) <> (pred = c)) as err from nb cross join (values (0), (1)) z(c) group by 1, 2),
f as (select setting, avg(case when 2 * tp + err = 0 then 0.0::double else 2 * tp / (2 * tp + err) end) as macro_f1 from c where tp + err > 0 group by 1)
select setting, round(macro_f1, 6) as macro_f1, (select count(*) from trw where trw.setting = f.setting) as n_train from f""",
)
def low_resource(spark, d):
    lab = labelled(spark, d).select("doc_id", "label", "text")
    train = S.per_group(lab, 30, keys=["label"])
    return rounded(AU.low_resource(train, lab, methods=_LOW, synonyms=SYN), "macro_f1")
