"""Decontamination, target resampling and phrase mining against brute force and on odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quillspark.llm import decontaminate, importance, phrases

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = ["", None, " \t\n.,", "one", "One TWO", "b b b b b b b b b b b b", "x y " * 4000, "é ß 12 !! ÄÖ", "a\x1cb  c\x85d　e", "Ça\x00va", "same text here", "same text here"]


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words_of(text):
    return PLAIN.findall(lower(text))


# --- decontamination -------------------------------------------------------------------


def leaks(docs, items, size):
    windows = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        for k in range(max(len(w) - size, 0) + 1 if w else 0):
            windows[tuple(w[k : k + size])].add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= owners
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("budget", [decontaminate.BROADCAST_BYTES, 0])
def test_contamination_equals_brute_force(spark, budget):
    rng = random.Random(3)
    text = lambda n: rng.choice(" .,-!").join(rng.choice("a B c d É f".split()) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 4, 5, 6, 9, 14]))) for i in range(25)] + [(None, "z z z z"), (3, "b é"), (50, None), (51, "..")]
    docs = [(i, text(rng.randrange(0, 40))) for i in range(60)] + [(None, "a b"), (7, "z z z z z"), (7, "z z z z z"), (7, None)]
    docs += [(100 + i, t) for i, t in enumerate(ODD)] + [(300, " ".join(x or "" for _, x in items))]
    d = spark.createDataFrame([(*r, 1, "c") for r in docs], "doc_id long, text string, row int, words string")  # names the operator uses itself
    b = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, win int")
    got = decontaminate.find_contamination(d, b, size=5, broadcast_bytes=budget).collect()
    found = [(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), list(r["items"])) for r in got]
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(found, key=key) == sorted(leaks(docs, items, 5), key=key)
    for r in got:  # spans are in order and neither overlap nor touch
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_contamination_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    b = spark.createDataFrame([("i", "b c")], "item_id string, text string")
    assert decontaminate.find_contamination(d.limit(0), b).count() == 0
    row = decontaminate.find_contamination(d, b.limit(0)).collect()
    assert [(r["n_words"], r["spans"], r["items"]) for r in row] == [(3, [], [])]
    assert decontaminate.find_contamination(d, b).first()["items"] == ["i"]


# --- target resampling -----------------------------------------------------------------


def test_joined_crcs_equal_those_of_whole_runs():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdéß漢𝄞") for _ in range(rng.randrange(1, 70))) for _ in range(60)]
    raw = [w.encode() for w in words]
    crc, octets = np.array([zlib.crc32(x) for x in raw], np.uint32), np.array([len(x) for x in raw])
    want = [zlib.crc32(" ".join(words[i : i + n]).encode()) for n in (1, 2, 3, 4) for i in range(len(words) - n + 1)]
    assert importance.run_crcs(crc, octets, 4).tolist() == want
    assert importance.run_crcs(crc[:2], octets[:2], 4).tolist() == [*want[:2], zlib.crc32(" ".join(words[:2]).encode())]


@pytest.mark.parametrize("known", [[], ["b"], ["one", "same", "é", "x"], ["one", "two", "b", "x", "y", "same", "text", "here", "12"]])
def test_scanner_emits_every_word(known):
    scan = importance.Scanner(known)
    for text in [*ODD, "b one B! unknown", "bb b bb", "x" * 5000 + " x"]:
        crc, octets = scan.payloads(text)
        raw = [w.encode() for w in words_of(text)]
        assert crc.tolist() == [zlib.crc32(w) for w in raw] and octets.tolist() == [len(w) for w in raw]


def resampled(docs, target, n, buckets, least, percent):
    def runs(text):
        w = words_of(text)
        return [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)], len(w)

    slot = lambda r: zlib.crc32(r.encode()) % buckets
    s = Counter(slot(r) for _, t in docs for r in runs(t)[0])
    t = Counter(slot(r) for x in target for r in runs(x)[0])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for doc_id, text in docs:
        r, k = runs(text)
        weight = sum(gain(slot(x)) for x in r)
        h = None if doc_id is None else int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(r), weight, None if h is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), k])
    able = sorted((x for x in out if x[4] >= least and x[3] is not None), key=lambda x: (-x[3], x[0]))
    rank = {id(x): i + 1 for i, x in enumerate(able[: percent * len(able) // 100])}
    return [(*x[:4], rank.get(id(x))) for x in out]


@pytest.mark.parametrize("n, size", [(1, 50_000), (1, 3), (3, 10), (2, 0)])
def test_resampling_equals_brute_force(spark, monkeypatch, n, size):
    monkeypatch.setattr(importance, "_ROWS_PER_RANGE", 20)  # several ranges
    rng = random.Random(n)
    text = lambda k: " ".join(rng.choice("alpha Beta gamma, delta é ß two three".split()) for _ in range(k))
    docs = [(i, text(rng.randrange(0, 30))) for i in range(120)] + [(None, text(25)), (500, text(30)), (500, text(30))]
    docs += [(600 + i, t) for i, t in enumerate(ODD)]
    target = [text(9), None, "", "gamma gamma unseen"]
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, rank int, buckets int")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(d, goal, max_words=n, buckets=97, least_words=8, percent=30, size=size).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    rows = [(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got]
    assert sorted(rows, key=key) == sorted(resampled(docs, target, n, 97, 8, 30), key=key)


def test_resampling_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert importance.resample(d.limit(0), d).count() == 0
    assert importance.resample(d, d.limit(0), least_words=1, percent=100).first()["rank"] == 1


# --- phrases ---------------------------------------------------------------------------


def mined(docs, least, longest):
    f, n = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    common = {p: a for p, a in f.items() if a >= least and len(p[1]) >= 2}
    inside = lambda x, y: len(x) < len(y) and any(y[i : i + len(x)] == x for i in range(len(y) - len(x) + 1))
    out = []
    for (lang, p), a in common.items():
        score, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        if not any(g == lang and inside(p, q) and 100 * b >= 50 * a for (g, q), b in common.items()):
            out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    return out


def phrase_docs():
    rng = random.Random(11)
    text = lambda: "".join(rng.choice("the of And to New York city é b c d".split()) + rng.choice("   \t.,\n") for _ in range(rng.randrange(0, 60)))
    docs = [(rng.choice(["en", "de", None, "und"]), text()) for _ in range(150)]
    return docs + [("en", t) for t in ODD] + [("xx", "rare words only here")] + [("en", "far away , far away")] * 8


@pytest.mark.parametrize(
    "least, longest, options",
    [(4, 3, {}), (4, 3, {"one_in": 1000}), (3, 4, {"one_in": 2, "held": 50}), (4, 3, {"most_bits": 64}), (2, 2, {"held": 3}), (2, 5, {"one_in": 1})],
)
def test_phrases_equal_brute_force(spark, monkeypatch, least, longest, options):
    """Whatever the sample, the length of a stretch and the size of the filters."""
    monkeypatch.setattr(phrases, "LEAST_BITS", 64)
    docs = phrase_docs()
    d = spark.createDataFrame([(*r, 1, "f") for r in docs], "lang string, text string, size int, phrase string").repartition(3)
    got = phrases.collocations(d, min_count=least, max_words=longest, limit=10**6, **options).collect()
    want = mined(docs, least, longest)
    rows = [(r["lang"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got]
    assert len(want) > 20 and sorted(rows) == sorted(want)
    by_lang = defaultdict(list)
    for r in sorted(want, key=lambda r: (-r[6], -r[2], r[1].encode())):
        by_lang[r[0]].append(r[1])
    for lang, some in by_lang.items():
        assert [r["phrase"] for r in sorted((r for r in got if r["lang"] == lang), key=lambda r: r["rank"])] == some


def test_border_failures_are_counted_by_an_expansion(spark, monkeypatch):
    passes = []
    count = phrases.count_phrases
    monkeypatch.setattr(phrases, "count_phrases", lambda *a: passes.append(a) or count(*a))
    d = spark.createDataFrame([("en", t) for _, t in phrase_docs()], "lang string, text string")
    phrases.frequent_phrases(d, min_count=3, one_in=10**6).count()
    assert len(passes) == 3  # the sample is empty, so all words fail the border


def test_exact_scores_beyond_64_bits(spark):
    big = 3 * 10**12
    rows = [("x", 0, "", 10**13), ("x", 1, "a", big + 7), ("x", 1, "b", big + 1), ("x", 2, "a b", big)]
    got = phrases.score_phrases(spark.createDataFrame(rows, "lang string, size int, phrase string, f long")).first()
    assert got["score"] == 1000000 * big * big // ((big + 7) * (big + 1))


def test_phrases_of_an_empty_table(spark):
    d = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(d).count() == 0
