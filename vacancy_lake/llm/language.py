"""Language of each word by a linear-chain conditional random field, and of each text from its words.

A word's features are its prefixes and suffixes, its letter n-grams and its entry in the lexicon (the
languages that the training texts use the word in).  Transitions between the labels of neighbouring
words are learned with the rest, from texts of one language and from texts put together of runs in
several (code-switching).  Forward-backward gives every word's label probabilities; a text's language
is the one that holds most of its letters.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import Codes, append_columns

#: Hashed features: a bound on the model's size.
BUCKETS = 1 << 18
#: Training rows: a bounded sample, the distinct texts with the smallest hashes, this many of each language.
ROWS_PER_LANGUAGE = 800
#: Words of a training row that are used, from a place that its hash draws.
SPAN = 60
#: Words that get their own lexicon entry: those with this many training occurrences.
LEXICON_MIN = 2
#: Distinct words that a worker remembers, and letters of these: bounds on memory, not on results.
WORD_LIMIT, WORD_LETTERS = 200_000, 8 << 20
#: Letters of the texts that are labelled together.
GROUP_LETTERS = 1_000_000
#: Longer texts are cut into pieces of this many words, which advance together.
PIECE_WORDS = 512
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters (Unicode category L), in lower case."""
    words = WORD.findall(text.lower())
    if all(map(str.isalpha, words)):
        return words
    # The pattern counts numbers that are no decimal digits (fractions, Roman ones) with letters.
    return "".join(c if c.isalpha() else " " for w in words for c in (*w, " ")).split()


def feature_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words, one word after another, and how many each has.

    Letters are numbered and windows of one to four of them, with the word's borders, are hashed
    with their kind: 1-4-grams anywhere, prefixes and suffixes of up to four letters apart.
    """
    joined = "".join(f"<{w}>" for w in words)
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    last = first + np.repeat(sizes, sizes) - 1
    place = np.arange(len(points))
    mix = np.uint64(0x9E3779B97F4A7C15)
    parts, owners = [], []
    value = np.zeros(len(points), dtype=np.uint64)
    for n in range(1, 5):
        ahead = np.minimum(place + n - 1, len(points) - 1)
        value = (value ^ points[ahead]) * mix
        value ^= value >> np.uint64(29)
        inside = place + n - 1 <= last
        for kind, where in ((0, inside), (1, inside & (place == first)), (2, inside & (place + n - 1 == last))):
            at = np.flatnonzero(where)
            h = (value[at] + np.uint64(kind * 1000 + n)) * np.uint64(0xC2B2AE3D27D4EB4F)
            parts.append((h >> np.uint64(40)) % np.uint64(BUCKETS))
            owners.append(word[at])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(parts)[order].astype(np.int64), np.bincount(owner, minlength=len(words))


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # hashed feature x label
    lexicon: dict[str, np.ndarray]  # word -> log share of each label, shifted to zero mean
    trust: float  # weight of the lexicon's entries
    start: np.ndarray
    moves: np.ndarray  # from label x to label

    def scores(self, words: list[str]) -> np.ndarray:
        """word x label: what the word alone says."""
        hashes, counts = feature_hashes(words)
        ends = np.cumsum(counts)
        total = np.add.reduceat(self.weights[hashes], ends - counts, axis=0)
        entries = np.array([self.lexicon.get(w, np.zeros(len(self.labels))) for w in words])
        return total / np.sqrt(counts)[:, None] + self.trust * entries


def cut(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of at most ``most`` words of sequences laid end to end: first word, size, rank in the
    sequence, and whether it is the sequence's last."""
    counts = -(-lengths // most)
    rank = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = np.repeat(np.cumsum(lengths) - lengths, counts) + rank * most
    sizes = np.minimum(most, np.repeat(lengths, counts) - rank * most)
    return begins, sizes, rank, rank == np.repeat(counts, counts) - 1


def borders(e: np.ndarray, a: np.ndarray, start: np.ndarray, pieces: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Forward values that enter each piece and backward values at its last word, both scaled.

    What a piece does to any vector is one label x label matrix.  The matrices of all pieces are
    multiplied out together, then the vectors go from piece to piece, so the result is exact.
    """
    begins, sizes, rank, last = pieces
    k = e.shape[1]
    enter, leave = np.tile(np.exp(start), (len(begins), 1)), np.ones((len(begins), k))
    own = np.flatnonzero((rank > 0) | ~last)
    if not len(own):
        return enter, leave
    own = own[np.argsort(-sizes[own], kind="stable")]
    through = np.zeros((len(begins), k, k))
    product = e[begins[own]][:, :, None] * np.eye(k)
    steps = int(sizes[own[0]])
    for t, n in zip(range(1, steps), np.searchsorted(-sizes[own], -np.arange(1, steps), side="left"), strict=True):
        now = (product[:n].reshape(-1, k) @ a).reshape(-1, k, k) * e[begins[own[:n]] + t][:, None, :]
        product[:n] = now / now.sum(axis=(1, 2), keepdims=True)
    through[own] = product
    for r in range(1, int(rank.max()) + 1):
        at = np.flatnonzero(rank == r)
        now = np.einsum("ni,nij->nj", enter[at - 1], through[at - 1]) @ a
        enter[at] = now / now.sum(axis=1, keepdims=True)
    for r in range(int(rank.max()) - 1, -1, -1):
        at = np.flatnonzero((rank == r) & ~last)
        now = np.einsum("nij,nj->ni", through[at + 1], leave[at + 1]) @ a.T
        leave[at] = now / now.sum(axis=1, keepdims=True)
    return enter, leave


def forward_backward(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, moves: np.ndarray, learn: bool = False):
    """Label probabilities of every word of sequences laid end to end and, to ``learn``, those of pairs
    of neighbours, summed.  All sequences advance together, longest first, so a step is one
    matrix product; probabilities are scaled at each step.  To ``learn`` sequences are not cut."""
    k = scores.shape[1]
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    a = np.exp(moves)
    pieces = cut(lengths, max(1, int(lengths.max(initial=0))) if learn else PIECE_WORDS)
    now, leave = borders(e, a, start, pieces)
    order = np.argsort(-pieces[1], kind="stable")
    begins, sizes, now, leave = pieces[0][order], pieces[1][order], now[order], leave[order]
    alpha, beta = np.empty_like(e), np.empty_like(e)
    steps = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(steps), side="left") if steps else []
    for t in range(steps):
        n = int(alive[t])
        at = begins[:n] + t
        now = (now[:n] if t == 0 else now[:n] @ a) * e[at]
        now /= now.sum(axis=1, keepdims=True)
        alpha[at] = now
    nxt = np.ones((0, k))
    pairs = np.zeros((k, k))
    for t in range(steps - 1, -1, -1):
        n = int(alive[t])
        at = begins[:n] + t
        own = leave[:n].copy()
        m = len(nxt)
        if m:
            ahead = e[at[:m] + 1] * nxt
            own[:m] = ahead @ a.T
            if learn:
                joint = alpha[at[:m]][:, :, None] * a[None] * ahead[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            own[:m] /= own[:m].sum(axis=1, keepdims=True)
        beta[at] = own
        nxt = own
    both = alpha * beta
    return both / both.sum(axis=1, keepdims=True), pairs


def training_rows(docs: DataFrame, per_language: int, text_col: str, lang_col: str) -> list[tuple]:
    """The bounded sample: of each language the ``per_language`` distinct texts with the smallest hashes."""
    from pyspark.sql.window import Window

    rows = docs.select(
        F.col(text_col).alias("t"), F.col(lang_col).alias("l"), F.xxhash64(text_col).alias("h")
    ).filter("t IS NOT NULL AND l IS NOT NULL")
    # Copies of a text count once.  The languages are the model's labels: few, whatever the number of rows.
    counted = rows.groupBy("l", "h").agg(F.lit(1).alias("one")).groupBy("l").agg(F.count("*").alias("n"))
    counts = {r.l: r.n for r in counted.collect()}
    if not counts:
        return []
    # A cut that leaves about twice the texts needed comes before the ranking, so that no task ranks
    # all texts of a language and only the sample's texts are moved.
    share = F.coalesce(
        *[F.when(F.col("l") == k, F.lit(min(1.0, (2.0 * per_language + 200) / n))) for k, n in counts.items()]
    )
    near = rows.filter(F.pmod(F.xxhash64("h"), F.lit(1_000_000)) < share * 1_000_000)
    # Only a span of a long text is moved: its letters around a place drawn by the hash.
    span = F.lit(SPAN * 12)
    begin = F.pmod("h", F.greatest(F.lit(1).cast("long"), F.length("t") - span)).cast("int")
    spans = near.select("l", "h", F.substring("t", begin + 1, span).alias("t"))
    distinct = spans.groupBy("l", "h").agg(F.min("t").alias("t"))
    ranked = distinct.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h")))
    taken = ranked.filter(F.col("r") <= per_language).select("l", "t", "h")
    return [tuple(r) for r in taken.sort("l", "h", "t").collect()]


def sequences(rows: list[tuple], labels: list[str], rng: np.random.Generator) -> list[tuple[list[str], np.ndarray]]:
    """Words and labels to learn from: every row's span, and as many sequences put together from
    runs of 3 to 15 words of rows of other languages."""
    number = {x: k for k, x in enumerate(labels)}
    spans = []
    for lang, text, _ in rows:
        words = words_of(text)[1:-1][:SPAN] or words_of(text)
        if words:
            spans.append((words, number[lang]))
    out = [(w, np.full(len(w), y)) for w, y in spans]
    for _ in range(len(spans) // 2 if len(labels) > 1 else 0):
        words, marks = [], []
        for pick in rng.integers(len(spans), size=4):
            own, y = spans[pick]
            n = int(rng.integers(3, 16))
            at = int(rng.integers(max(1, len(own) - n)))
            words += own[at : at + n]
            marks += [y] * len(own[at : at + n])
        out.append((words, np.array(marks)))
    return out


def train(rows: list[tuple], labels: list[str], rounds: int = 6, rate: float = 0.3, seed: int = 10) -> Model:
    """Weights by gradient steps (AdaGrad) on the sequences' log-likelihood."""
    rng = np.random.default_rng(seed)
    k = len(labels)
    seen: dict[str, Counter] = {}
    for lang, text, _ in rows:
        for w in words_of(text):
            seen.setdefault(w, Counter())[lang] += 1
    lexicon = {}
    for w, c in seen.items():
        if sum(c.values()) >= LEXICON_MIN:
            logs = np.log([c[x] + 0.5 for x in labels])
            lexicon[w] = logs - logs.mean()
    model = Model(labels, np.zeros((BUCKETS, k)), lexicon, 0.5, np.zeros(k), np.zeros((k, k)))
    data = sequences(rows, labels, rng)
    grown = [np.full_like(x, 1e-3) for x in (model.weights, model.start, model.moves)]
    for _ in range(rounds):
        order = rng.permutation(len(data))
        for a in range(0, len(order), 200):
            part = [data[i] for i in order[a : a + 200]]
            lengths = np.array([len(w) for w, _ in part])
            words = [w for ws, _ in part for w in ws]
            gold = np.concatenate([y for _, y in part])
            hashes, counts = feature_hashes(words)
            own = np.repeat(np.arange(len(words)), counts)
            scores = model.scores(words)
            found, pairs = forward_backward(scores, lengths, model.start, model.moves, learn=True)
            error = -found
            error[np.arange(len(gold)), gold] += 1
            error /= len(part)
            step = (error / np.sqrt(counts)[:, None])[own]
            g_w = np.stack([np.bincount(hashes, step[:, y], BUCKETS) for y in range(k)], axis=1)
            begins = np.cumsum(lengths) - lengths
            g_s = error[begins].sum(axis=0)
            truth = np.zeros((k, k))
            inner = np.setdiff1d(np.arange(1, len(gold)), begins)
            np.add.at(truth, (gold[inner - 1], gold[inner]), 1)
            g_m = (truth - pairs) / len(part)
            for x, g, h in zip((model.weights, model.start, model.moves), (g_w, g_s, g_m), grown, strict=True):
                h += g * g
                x += rate * g / np.sqrt(h)
    model.weights = model.weights.astype(np.float32)
    return model


def fit(
    docs: DataFrame, per_language: int = ROWS_PER_LANGUAGE, text_col: str = "text", lang_col: str = "lang"
) -> Model:
    """A model from ``docs``: labels are its non-null languages; the sample is bounded by
    ``per_language`` rows and about SPAN words of each.  Without a labelled text there are no labels."""
    rows = [r for r in training_rows(docs, per_language, text_col, lang_col) if words_of(r[1])]
    labels = sorted({r[0] for r in rows})
    return train(rows, labels) if labels else Model([], np.zeros((1, 0)), {}, 0.0, np.zeros(0), np.zeros((0, 0)))


class WordScores:
    """Scores of the distinct words that a worker has met."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.codes, self.held = Codes(), 0
        self.rows: list[np.ndarray] = []

    def look_up(self, model: Model, texts: list[list[str]]) -> np.ndarray:
        if len(self.codes) > WORD_LIMIT or self.held > WORD_LETTERS:
            self.clear()
        look = self.codes.__getitem__
        codes = np.array([look(w) for words in texts for w in words], dtype=np.int64)
        fresh, self.codes.fresh = self.codes.fresh, []
        self.held += sum(map(len, fresh))
        for a in range(0, len(fresh), 20_000):
            self.rows.append(model.scores(fresh[a : a + 20_000]).astype(np.float32))
        if len(self.rows) > 1:
            self.rows = [np.concatenate(self.rows)]
        return self.rows[0][codes] if self.rows else np.zeros((0, len(model.labels)))


_caches: dict[str, WordScores] = {}


def cache_of(key: str) -> WordScores:
    """The worker's scores for one fitted model; those of an earlier model are let go."""
    if key not in _caches:
        _caches.clear()
        _caches[key] = WordScores()
    return _caches[key]


def label_words(model: Model, texts: list[list[str]], cache: WordScores | None = None) -> list[np.ndarray]:
    """word x label probabilities of each text (a list of words)."""
    cache = cache or WordScores()
    lengths = np.array([len(w) for w in texts], dtype=np.int64)
    scores = cache.look_up(model, texts).astype(np.float64)
    if not len(scores):
        return [np.zeros((0, len(model.labels)))] * len(texts)
    found, _ = forward_backward(scores, lengths, model.start, model.moves)
    return np.split(found, np.cumsum(lengths)[:-1])


def predict(model: Model, texts: list[bytes | None], cache: WordScores | None = None) -> tuple[list[str], list[float]]:
    """Language and score of each text: the share of its letters that the language holds."""
    if not model.labels:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    langs, scores = [], []
    ends = np.cumsum([len(x or b"") for x in texts])
    for group in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends // GROUP_LETTERS)) + 1):
        strings = [(texts[k] or b"").decode("utf-8") for k in group]
        words = [words_of(s) for s in strings]
        for own, p in zip(words, label_words(model, words, cache), strict=True):
            if not own:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            letters = np.array([len(w) for w in own], dtype=np.float64)
            share = letters @ p / letters.sum()
            langs.append(model.labels[int(share.argmax())])
            scores.append(min(1.0, float(share.max())))
    return langs, scores


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (the columns of ``keep``, or all) with ``lang_pred`` and ``score``.

    ``und`` and score 0 if the text is null or has no letter, or the model no label.  Of labels that
    hold equally many letters the first in order wins.  Nothing but the text is read.
    """
    import uuid

    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def compute(texts):
        return predict(shared.value, texts, cache_of(key))

    return append_columns(docs, text_col, compute, FIELDS, keep)


def keep_known(docs: DataFrame, model: Model, least_score: float, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows whose language is ``und`` or scores less."""
    import uuid

    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def known(texts):
        langs, scores = predict(shared.value, texts, cache_of(key))
        return ([x != UNKNOWN and s >= least_score for x, s in zip(langs, scores, strict=True)],)

    flag = T.StructField("__known", T.BooleanType())
    return append_columns(docs, text_col, known, [flag], where="__known").drop("__known")


def label_tokens(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, position, word, lang, score of every word: the labels of code-switched text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[id_col], T.StructField("position", T.IntegerType()), T.StructField("word", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, ids, texts = shared.value, batch.column(id_col), batch.column(text_col).to_pylist()
            for a in range(0, len(texts) if m.labels else 0, 200):
                words = [words_of(x or "") for x in texts[a : a + 200]]
                found = label_words(m, words)
                counts = [len(w) for w in words]
                rows = np.repeat(np.arange(a, a + len(words)), counts)
                p = np.concatenate(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows)),
                        pa.array(np.concatenate([np.arange(n) for n in counts]), pa.int32()),
                        pa.array([w for ws in words for w in ws], pa.string()),
                        pa.array([m.labels[k] for k in p.argmax(axis=1)], pa.string()),
                        pa.array(p.max(axis=1), pa.float64()),
                    ],
                    names=schema.names,
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)
