"""Hand fixtures for text functions, rules and parsers."""

import pytest
from pyspark.sql import functions as F

from quillspark.functions import lexicons as lx, parsing as P, rules as R, text as T
from quillspark.operators import labeling as L


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw, want", [(None, ""), (" a\r\nb ", "a  b"), ("　好　", "好")])
def test_simple_clean(spark, raw, want):
    assert one(spark, raw, T.simple_clean) == want


@pytest.mark.parametrize(
    "raw, want",
    [(r"\u4e2d\u6587", "中文"), (r"\u0041", r"\u0041"), (r"好\u4e2d", "好中"), (r"\xe9t\xe9", "été"), ("plain", "plain"), (r"\ud800x", r"\ud800x"), (r"a\uD83D\uDE00\u597d", "a😀好"), (None, None)],
)
def test_decode_escapes(spark, raw, want):
    assert one(spark, raw, T.decode_escapes) == want


def test_nfkc_and_control(spark):
    assert one(spark, "ａ１！", T.nfkc) == "a1!"
    assert one(spark, "ａ１！　b", T.fold_fullwidth) == "a1! b"
    assert one(spark, "a\x00b\x7fc", T.strip_control) == "abc"


def test_lengths_and_display(spark):
    assert one(spark, " a  b c ", T.word_count) == 3
    assert one(spark, "x" * 10, T.truncate_display) == "x" * 10
    assert one(spark, "x" * 11, T.truncate_display) == "x" * 10 + "..."


def test_tokenize_mixed_scripts(spark):
    assert one(spark, "房间abc很好", lambda c: T.tokenize(c, [])) == ["房间", "abc", "很好"]
    assert one(spark, "服务热情", lambda c: T.tokenize(c, [])) == ["服务", "务热", "热情"]
    assert one(spark, "好 的 酒店", T.tokenize) == ["好", "酒店"]
    assert one(spark, "The cat, the dog", lambda c: T.tokenize(c, ["the"], 2)) == ["cat", "dog"]


def test_ngrams(spark):
    assert one(spark, "a b c", lambda c: T.ngrams_1_2(F.split(c, " "))) == ["a", "b", "c", "a b", "b c"]
    assert one(spark, "a", lambda c: T.ngrams_1_2(F.split(c, " "))) == ["a"]


def test_presence_counts_each_word_once(spark):
    assert one(spark, "不好不好", lambda c: T.presence_count(c, ["好", "不好"])) == 2


def test_emoji_words(spark):
    assert one(spark, "真😀👍", T.emoji_to_word) == "真笑赞"


VOTES = [
    ("房间干净，服务热情", [-1, 1, 1, -1, -1, -1, -1, -1, -1], 1, 1.0),
    ("不推荐!!", [-1, -1, -1, 0, -1, 1, -1, -1, 1], 1, 2 / 3),
    ("太差了", [-1, -1, -1, -1, 0, -1, -1, -1, -1], 0, 1.0),
    ("一般", [-1] * 9, 0, 0.5),
    ("干净但是吵", [-1] * 9, 0, 0.5),
    ("不喜欢👍", [-1, -1, -1, 0, -1, -1, -1, 1, -1], 0, 0.5),
]


@pytest.mark.parametrize("text, votes, label, conf", VOTES)
def test_default_rules_and_vote(spark, text, votes, label, conf):
    rules = R.default_rules()
    df = L.vote(L.apply_rules(spark.createDataFrame([(text,)], "text string"), rules), list(rules))
    r = df.first()
    assert [r[f"vote_{n}"] for n in rules] == votes
    assert r["weak_label"] == label and r["confidence"] == pytest.approx(conf)
    assert r["all_abstain"] == all(v == -1 for v in votes)


def test_shadowed_words(spark):
    # The positive list is tested first, so the longer negative word cannot win.
    assert one(spark, "不推荐", R.first_match_rule(lx.RECOMMEND_POS, lx.RECOMMEND_NEG)) == 1
    assert one(spark, "不推荐", R.first_match_rule(lx.RECOMMEND_POS, lx.RECOMMEND_NEG, pos_first=False)) == 0
    assert one(spark, "不满意", R.first_match_rule(lx.DICTIONARY_POS, lx.DICTIONARY_NEG)) == 1


def test_keyword_label_ties(spark):
    assert one(spark, "好差", lambda c: R.keyword_label(c)) == 0
    ties = spark.range(200).select(R.keyword_label(F.lit("好差"), tie_id=F.col("id")).alias("y")).groupBy("y").count()
    assert {r["y"] for r in ties.collect()} == {0, 1}


def test_rule_then_score(spark):
    df = spark.createDataFrame([(1, 0.1), (-1, 0.8), (-1, 0.2), (-1, 0.5), (-1, None)], "r int, s double")
    lab, src = R.rule_then_score(F.col("r"), F.col("s"), 0.8)
    got = [(x["l"], x["s"]) for x in df.select(lab.alias("l"), src.alias("s")).collect()]
    # 1 - 0.8 is a little below 0.2 in floating point, so 0.2 abstains.
    assert got == [(1, "rule"), (1, "model_high"), (-1, "abstain"), (-1, "abstain"), (-1, "abstain")]


def test_policy(spark):
    assert [one(spark, t, R.policy_label) for t in ("很赞", "赞但差", "一般")] == [1, 0, -1]


@pytest.mark.parametrize(
    "response, want", [("正面", 1), ("负面。", 0), ("This is Positive", 1), ("差评", 0), ("不知道", -1), ("负面，不是正面", 1)]
)
def test_parse_sentiment(spark, response, want):
    assert one(spark, response, P.sentiment_of_response) == want


def test_parse_triplets(spark):
    fenced = '```json [{"aspect":"服务","opinion":"好","sentiment":"正面"},{"aspect":"价格"}] ```'
    assert [tuple(t) for t in one(spark, fenced, P.triplets_of_response)] == [("服务", "好", "正面")]
    for bad in ("no json", '{"aspect":"a","sentiment":"b"}', "", None):
        assert one(spark, bad, P.triplets_of_response) == []


def test_parse_analysis(spark):
    r = one(spark, "not json", P.analysis_of_response)
    assert tuple(r) == ("未知", "not json", "需要进一步分析")
    assert tuple(one(spark, '{"error_reason": "x"}', P.analysis_of_response)) == ("x", "", "")


def test_gold_triplets(spark):
    assert one(spark, "配送,慢,NEG;菜品,新鲜,POS", P.gold_triplets) == ["配送,慢,NEG", "菜品,新鲜,POS"]
    assert one(spark, "[('配送', '慢', 'NEG')]", P.gold_triplets) == ["配送,慢,NEG"]
    assert one(spark, "[broken", P.gold_triplets) == []
    assert one(spark, None, P.gold_triplets) == []
