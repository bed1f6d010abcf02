"""Word-level language labels by a linear-chain conditional random field.

Each word has affix, letter n-gram and lexicon features (hashed) with a weight
per language; neighbouring words are tied by learned transition weights. The
forward-backward pass gives the probability of each language at each word, so
code-switched texts get a label per word, and a text the language with the
largest share.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

_WORD = re.compile(r"[^\W\d_]+")
_SLOTS = 1 << 17
_CHAIN = 64  # words of a chain; longer texts are several chains
_KEPT = 400_000
UNKNOWN = "und"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(word: str) -> list[int]:
    """Slots of the word itself, its affixes of up to 4 letters and its letter triples."""
    if len(word) > 40:
        word = word[:20] + word[-20:]  # only the ends of such runs are looked at
    edge = f"^{word}$"
    parts = [f"w{word}"]
    parts += [f"p{word[:k]}" for k in (1, 2, 3)]
    parts += [f"s{word[-k:]}" for k in (1, 2, 3, 4)]
    parts += [edge[i : i + 3] for i in range(len(edge) - 2)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) & (_SLOTS - 1) for p in parts]


@dataclass
class Model:
    """Languages, feature weights (a row per slot, then one per lexicon), transitions and lexicon."""

    langs: list[str]
    weights: np.ndarray
    moves: np.ndarray
    lexicon: dict[str, int]
    _ids: dict[str, int] = field(default_factory=dict)
    _scores: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "_ids": {}, "_scores": None}

    def slots(self, word: str) -> list[int]:
        got = features(word)
        return [*got, _SLOTS + self.lexicon[word]] if word in self.lexicon else got

    def scores(self, words: list[str]) -> np.ndarray:
        """A row of language scores per word; words seen before are looked up."""
        if len(self._ids) > _KEPT:
            self._ids, self._scores = {}, None
        new = [w for w in dict.fromkeys(words) if w not in self._ids]
        if new:
            slots = [self.slots(w) for w in new]
            starts = np.cumsum([0, *map(len, slots[:-1])])
            got = np.add.reduceat(self.weights[np.concatenate(slots)], starts, axis=0)
            base = len(self._ids)
            self._ids.update(zip(new, range(base, base + len(new))))
            self._scores = got if self._scores is None else np.concatenate([self._scores, got])
        return self._scores[np.fromiter(map(self._ids.__getitem__, words), np.int64, len(words))]


def forward_backward(scores: np.ndarray, moves: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (chain, place, label) and summed pair marginals (label, label) of many chains.

    ``mask`` is True at the places in use, from the first on.
    """
    s, t, n = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    e[~mask] = 1.0 / n
    m = np.exp(moves)
    alpha, beta = np.empty_like(e), np.empty_like(e)
    a = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    alpha[:, 0] = a
    for i in range(1, t):
        b = (a @ m) * e[:, i]
        b /= b.sum(axis=1, keepdims=True)
        a = np.where(mask[:, i, None], b, a)
        alpha[:, i] = a
    b = np.ones((s, n))
    beta[:, t - 1] = b
    pairs = np.zeros((n, n))
    for i in range(t - 2, -1, -1):
        on = mask[:, i + 1, None]
        ahead = e[:, i + 1] * b
        c = ahead @ m.T
        norm = (alpha[:, i] * c).sum(axis=1, keepdims=True)
        pairs += ((alpha[:, i] / norm) * on).T @ ahead
        b = np.where(on, c / c.sum(axis=1, keepdims=True), 1.0)
        beta[:, i] = b
    p = alpha * beta
    p /= p.sum(axis=2, keepdims=True)
    return p, pairs * m


def train(texts: list[tuple[str, str]], sequences: int = 3000, length: int = 32, steps: int = 60, rate: float = 0.5, l2: float = 1e-5, seed: int = 11) -> Model:
    """Fit on (text, language) pairs.

    Texts have one language each; code-switched chains are made of runs of
    several texts, so that transitions are learned too.
    """
    langs = sorted({lang for _, lang in texts})
    number = {lang: i for i, lang in enumerate(langs)}
    streams: dict[int, list[list[str]]] = defaultdict(list)
    for text, lang in texts:
        if found := words_of(text):
            streams[number[lang]].append(found)
    counts: dict[str, Counter] = defaultdict(Counter)
    for i, lists in streams.items():
        for found in lists:
            for w in found:
                counts[w][i] += 1
    lexicon = {w: c.most_common(1)[0][0] for w, c in counts.items() if c.total() >= 5 and c.most_common(1)[0][1] >= 0.8 * c.total()}
    n = max(1, len(langs))
    model = Model(langs, np.zeros((_SLOTS + n, n), np.float32), np.zeros((n, n)), lexicon)
    if not streams:
        return model
    rng, known = np.random.default_rng(seed), sorted(streams)
    ids: dict[str, int] = {}
    x, y = np.zeros((sequences, length), np.int64), np.zeros((sequences, length), np.int64)
    for s in range(sequences):
        at = 0
        while at < length:
            lang = known[rng.integers(len(known))]
            found = streams[lang][rng.integers(len(streams[lang]))]
            run = min(length - at, int(rng.integers(3, 2 * length)), len(found))
            start = int(rng.integers(len(found) - run + 1))
            x[s, at : at + run] = [ids.setdefault(w, len(ids)) for w in found[start : start + run]]
            y[s, at : at + run] = lang
            at += run
    slots = [model.slots(w) for w in ids]
    flat, owner = np.concatenate(slots), np.repeat(np.arange(len(slots)), [len(q) for q in slots])
    starts = np.cumsum([0, *map(len, slots[:-1])])
    seen = np.zeros((n, n))
    np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    truth = np.stack([np.bincount(x.ravel(), (y == i).ravel(), len(ids)) for i in range(n)], axis=1)
    w, sq, sq_moves = np.zeros((_SLOTS + n, n)), np.full((_SLOTS + n, n), 1e-6), np.full((n, n), 1e-6)
    mask = np.ones((sequences, length), bool)
    for _ in range(steps):
        p, pairs = forward_backward(np.add.reduceat(w[flat], starts, axis=0)[x], model.moves, mask)
        word = (np.stack([np.bincount(x.ravel(), p[:, :, i].ravel(), len(ids)) for i in range(n)], axis=1) - truth) / sequences
        g = np.stack([np.bincount(flat, word[owner, i], _SLOTS + n) for i in range(n)], axis=1) + l2 * w
        g_moves = (pairs - seen) / sequences + l2 * model.moves
        sq += g * g
        sq_moves += g_moves * g_moves
        w -= rate * g / np.sqrt(sq)
        model.moves = model.moves - rate * g_moves / np.sqrt(sq_moves)
    model.weights = w.astype(np.float32)
    return model


def fit(rows: DataFrame, per_lang: int = 300, seed: int = 7, **kw) -> Model:
    """Train on at most ``per_lang`` texts of each language of (doc_id, text, lang).

    The texts are chosen by a hash of their id. Null languages and texts are
    left out. With no row the model knows no language.
    """
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang", F.xxhash64(F.lit(seed), "doc_id").alias("h"))
    # a share that keeps about twice the texts wanted, so that the ranks need few rows
    share = known.groupBy("lang").agg(F.least(F.lit(1.0), 2.0 * per_lang / F.count("*")).alias("share"))
    few = known.join(F.broadcast(share), "lang").where(F.pmod("h", F.lit(1 << 20)) < F.col("share") * (1 << 20))
    ranked = few.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))).where(F.col("k") <= per_lang)
    got = sorted((r["lang"], r["k"], r["text"]) for r in ranked.select("lang", "k", "text").collect())
    return train([(text, lang) for lang, _, text in got], **kw)


def marginals(model: Model, words: list[str], owner: np.ndarray) -> np.ndarray:
    """Language probabilities of words; ``owner`` names the text of each, ascending."""
    n = len(words)
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    place = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
    head = place % _CHAIN == 0
    chain = np.cumsum(head) - 1
    scores = np.zeros((int(chain[-1]) + 1, _CHAIN, len(model.langs)))
    mask = np.zeros(scores.shape[:2], bool)
    scores[chain, place % _CHAIN], mask[chain, place % _CHAIN] = model.scores(words), True
    return forward_backward(scores, model.moves, mask)[0][chain, place % _CHAIN]


def _texts(model: Model, texts: list[str | None], most: int = 100_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, marginals) of all words, at most so many words at a time."""
    words, owner = [], []
    for i, text in enumerate(texts):
        found = words_of(text or "")
        for at in range(0, len(found), most):
            part = found[at : at + most]
            words += part
            owner.append(np.full(len(part), i))
            if len(words) >= most:
                yield (o := np.concatenate(owner)), marginals(model, words, o)
                words, owner = [], []
    if words:
        yield (o := np.concatenate(owner)), marginals(model, words, o)


def detect(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Replace the text by ``lang_pred`` and ``score``, the language's share of the words.

    A text that is null or has no letter gets ``und`` and 0, as does every text
    if the model knows no language. Ties go to the first language by name.
    """
    others = [c for c in df.columns if c not in (text, "lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(text).to_pylist()
                total = np.zeros((len(texts), max(1, len(model.langs))))
                if model.langs:
                    for owner, p in _texts(model, texts):
                        for i in range(p.shape[1]):
                            total[:, i] += np.bincount(owner, p[:, i], len(texts))
                found = total.sum(axis=1)
                known = [bool(found[i] > 0 and any(map(str.isalpha, t))) for i, t in enumerate(texts)]
                best = total.argmax(axis=1)
                names = [model.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
                shares = [min(1.0, float(total[i, b] / found[i])) if k else 0.0 for i, (b, k) in enumerate(zip(best, known))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), pa.array(names, pa.string()), pa.array(shares, pa.float64())], [*others, "lang_pred", "score"])

    return df.mapInArrow(run, StructType([*(df.schema[c] for c in others), StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def label_words(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Replace the text by ``spans``: runs of words of one language (lang, words, score) in order.

    For code-switched texts; null texts and texts without a word give an empty list.
    """
    others = [c for c in df.columns if c not in (text, "spans")]
    span = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            spans: list[list[dict]] = [[] for _ in texts]
            for owner, p in _texts(model, texts) if model.langs else ():
                for i, best, score in zip(owner, p.argmax(axis=1), p.max(axis=1)):
                    runs, lang = spans[i], model.langs[best]
                    if runs and runs[-1]["lang"] == lang:
                        last = runs[-1]
                        last["score"] = (last["score"] * last["words"] + float(score)) / (last["words"] + 1)
                        last["words"] += 1
                    else:
                        runs.append({"lang": lang, "words": 1, "score": float(score)})
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(spans, span)], [*others, "spans"])

    kind = ArrayType(StructType([StructField("lang", StringType()), StructField("words", IntegerType()), StructField("score", DoubleType())]))
    return df.mapInArrow(run, StructType([*(df.schema[c] for c in others), StructField("spans", kind)]))
