"""Benchmark passages in documents, by edit distance: CGK walks, bit sampling, exact verification.

A CGK walk reads a word sequence and after each step moves on by one word or stays, as a random bit
for (step, word) says.  Two sequences at a small edit distance fall into step again and again, so
their walks agree at many steps: the edit distance has become a Hamming distance.  Sampling a few
steps of the walk gives hash keys.  A walk is run from every place of a text where an item could
begin; a place whose key is that of an item is a candidate, and the whole is repeated with new bits
and samples until of every single item the target share of simulated edits is found.  Items that do
not get there (a few words repeated over and over) get exact candidates: d edits leave one of d + 1
pieces of an item as it is, and every place that holds a piece is a candidate.  Candidates are
verified by the exact edit distance between the item and the closest run of words there.

Before the walks, places are left out where no item can be: a run of words within distance d of an
item of n words holds n - d words of items among its n + d, and may begin with one of them.  That
loses nothing.

Items are the query set: they go to the tasks in blocks of bounded size, one pass over the documents
for each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import append_columns, ragged, slices, texts_of
from .licences import WORDS
from .store import written

#: Words of items that one pass carries to the tasks: about 50 MB of index.
BLOCK_WORDS = 400_000
#: Words of documents that are handled at once in a task.
CHUNK_WORDS = 250_000
#: Steps that a hash key samples from a walk.
SAMPLES = 2
#: Repetitions after which an item gets exact candidates, and simulated edits of each item.
REPETITIONS = 64
DRAWS = 50


def words_of(text: bytes | None) -> list[bytes]:
    """Words of letters, digits and whatever is not ASCII; A-Z in lower case."""
    return (text or b"").translate(WORDS).split()


def allowed(length, rate: float):
    """Edits allowed for an item of so many words."""
    return np.floor(np.asarray(length) * rate + 1e-9).astype(np.int64)


@dataclass
class Repetition:
    """Random bits of one walk, the steps it samples, and the items by key."""

    bits: np.ndarray  # for each word code a 64-bit row; bit j % 64 of (row rotated by j // 64) is the move
    steps: list[int]
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    items: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def walk(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Key of the walk from each place of ``codes``; -1 if it samples a word of no item."""
        at = at.copy()
        key = np.zeros(len(at), dtype=np.int64)
        bad = np.zeros(len(at), dtype=bool)
        for j in range(self.steps[-1] + 1):
            word = codes[at]
            if j in self.steps:
                bad |= word <= 0
                key = key * len(self.bits) + word
            turn = np.uint64((j % 64) ^ ((j // 64) * 23 % 64))
            at += ((self.bits[word] >> turn) & np.uint64(1)).astype(np.int64)
        key[bad] = -1
        return key


@dataclass
class SizeClass:
    """Items of about one length."""

    rows: np.ndarray  # places in the block's list of items
    shortest: int
    window: int  # words of the longest item with all allowed insertions
    least: int  # words of items that the window must hold
    holds: np.ndarray  # by word code: a word of these items
    repetitions: list[Repetition]
    recall: np.ndarray  # by item: simulated edits at its limit that the repetitions find
    pieces: list[Pieces] = field(default_factory=list)


@dataclass
class Pieces:
    """Runs of ``length`` words of the items with exact candidates, sorted by key."""

    length: int
    keys: np.ndarray
    items: np.ndarray
    offsets: np.ndarray  # where in its item each run begins


def run_keys(codes: np.ndarray, length: int) -> np.ndarray:
    """A key for the ``length`` words from each place; places near the end have fewer."""
    key = np.zeros(len(codes), dtype=np.uint64)
    for j in range(length):
        word = np.concatenate([codes[j:], np.zeros(min(j, len(codes)), np.int64)]).astype(np.uint64)
        key = (key ^ word) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def exact_pieces(rows: list[int], codes: list[np.ndarray], limits: np.ndarray) -> list[Pieces]:
    """The limit + 1 pieces of each of the items ``rows``, by length."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    for r in rows:
        edges = np.linspace(0, len(codes[r]), int(limits[r]) + 2).astype(int).tolist()
        for a, b in zip(edges, edges[1:]):
            found.setdefault(b - a, []).append((int(run_keys(codes[r][a:b], b - a)[0]), r, a))
    out = []
    for length, own in sorted(found.items()):
        keys, items, offsets = zip(*sorted(own), strict=True)
        out.append(Pieces(length, np.array(keys, np.uint64), np.array(items), np.array(offsets)))
    return out


@dataclass
class ItemIndex:
    ids: list[int]
    codes: list[np.ndarray]
    limits: np.ndarray
    vocabulary: dict[bytes, int]
    classes: list[SizeClass]


def edited(codes: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """``codes`` after random edits, the new words being of no item; it begins with a kept word."""
    out = codes.tolist()
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(len(out) + 1))
        if kind == 0 or at == len(out):
            out.insert(at, 0)
        elif kind == 1:
            out[at] = 0
        elif len(out) > 1:
            out.pop(at)
    while out and out[0] == 0:
        out.pop(0)
    return np.array(out or [0], dtype=np.int64)


def padded(rows: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """All rows, each with ``width`` words of no item after it, and where each begins."""
    flat = np.concatenate([np.concatenate([r, np.zeros(width, np.int64)]) for r in rows])
    sizes = np.array([len(r) + width for r in rows])
    return flat, np.cumsum(sizes) - sizes


def build_class(rows, codes, limits, size: int, recall: float, rng: np.random.Generator, bits: list) -> SizeClass:
    """``bits``: the random rows of each repetition, which all classes share."""
    lengths = np.array([len(codes[r]) for r in rows])
    own = limits[rows]
    holds = np.zeros(size, dtype=bool)
    for r in rows:
        holds[codes[r]] = True
    holds[0] = False
    shortest, window = int(lengths.min()), int((lengths + own).max())
    made = SizeClass(np.array(rows), shortest, window, int((lengths - own).min()), holds, [], np.zeros(len(rows)))
    # Simulated edits at the limit, the hardest cases, say how many repetitions are needed.
    pairs = [(r, edited(codes[r], int(limits[r]), rng)) for r in rows for _ in range(DRAWS)]
    plain, begins = padded([codes[r] for r in rows], 2 * window)
    changed, starts = padded([e for _, e in pairs], 2 * window)
    place = {r: k for k, r in enumerate(rows)}
    of = np.array([place[r] for r, _ in pairs])
    found = np.zeros(len(pairs), dtype=bool)
    while len(made.repetitions) < 2 or (made.recall.min() < recall and len(made.repetitions) < REPETITIONS):
        reach = max(SAMPLES, shortest // 2) if len(made.repetitions) % 2 else max(SAMPLES, shortest)
        steps = sorted(rng.choice(reach, SAMPLES, replace=False).tolist()) if reach > SAMPLES else list(range(min(reach, shortest)))
        if len(made.repetitions) == len(bits):
            bits.append(rng.integers(0, 2**64, size, dtype=np.uint64))
        rep = Repetition(bits[len(made.repetitions)], steps or [0])
        keys = rep.walk(plain, begins)
        found |= (rep.walk(changed, starts) == keys[of]) & (keys[of] >= 0)
        order = np.argsort(keys, kind="stable")
        order = order[keys[order] >= 0]
        rep.keys, rep.items = keys[order], made.rows[order]
        made.repetitions.append(rep)
        made.recall = found.reshape(len(rows), DRAWS).mean(axis=1)
    short = np.flatnonzero(made.recall < recall)
    made.pieces = exact_pieces([rows[k] for k in short], codes, limits)
    made.recall[short] = 1.0
    return made


def build_index(items: list[tuple[int, bytes | None]], rate: float, recall: float, seed: int) -> ItemIndex:
    """Index of one block of items; those without words are left out."""
    rng = np.random.default_rng(seed)
    vocabulary: dict[bytes, int] = {}
    ids, codes = [], []
    for item_id, text in items:
        own = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        if own:
            ids.append(item_id)
            codes.append(np.array(own, dtype=np.int64))
    size = len(vocabulary) + 1
    lengths = np.array([len(c) for c in codes], dtype=np.int64)
    limits = allowed(lengths, rate)
    bits: list[np.ndarray] = []
    grouped: dict[int, list[int]] = {}
    for k, n in enumerate(lengths.tolist()):
        grouped.setdefault(int(np.log(n) / np.log(1.1)) if n > 10 else n, []).append(k)
    classes = [build_class(rows, codes, limits, size, recall, rng, bits) for _, rows in sorted(grouped.items())]
    return ItemIndex(ids, codes, limits, vocabulary, classes)


def edit_distances(item: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each region (row of word codes): the smallest edit distance between the item and any run of
    the region's words, and the first word after the first such run."""
    n = len(item)
    steps = np.arange(n + 1)
    now = np.broadcast_to(steps, (len(regions), n + 1)).copy()
    best, end = now[:, -1].copy(), np.zeros(len(regions), dtype=np.int64)
    for t in range(regions.shape[1]):
        new = np.empty_like(now)
        new[:, 0] = 0
        new[:, 1:] = np.minimum(now[:, 1:] + 1, now[:, :-1] + (regions[:, t : t + 1] != item))
        new = np.minimum.accumulate(new - steps, axis=1) + steps
        better = new[:, -1] < best
        best[better], end[better] = new[better, -1], t + 1
        now = new
    return best, end


def search(index: ItemIndex, texts: list[bytes | None]) -> list[tuple[int, int, int, int]]:
    """(text number, place of the item, edit distance, first word after the passage), best per pair."""
    out: list[tuple[int, int, int, int]] = []
    words, first, size = [], 0, 0
    for k, text in enumerate(texts):
        words.append(words_of(text))
        size += len(words[-1])
        if size >= CHUNK_WORDS or k + 1 == len(texts):
            out += [(first + d, *rest) for d, *rest in search_words(index, words)]
            words, first, size = [], k + 1, 0
    return out


def search_words(index: ItemIndex, words: list[list[bytes]]) -> list[tuple[int, int, int, int]]:
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    margin = max((c.window for c in index.classes), default=0) * 3 + 8
    code = index.vocabulary.get
    flat = np.zeros(int(lengths.sum()) + margin * (len(words) + 1), dtype=np.int64)
    begins = np.cumsum(lengths + margin) - lengths  # a margin of words of no item before every text
    for at, own in zip(begins.tolist(), words, strict=True):
        flat[at : at + len(own)] = [code(w, 0) for w in own]
    pairs = []
    for c in index.classes:
        held = c.holds[flat]
        before = np.concatenate([[0], np.cumsum(held)])
        places = np.flatnonzero(held[: len(flat) - margin])
        places = places[before[places + c.window] - before[places] >= c.least]
        for rep in c.repetitions:
            keys = rep.walk(flat, places)
            low, high = np.searchsorted(rep.keys, keys, "left"), np.searchsorted(rep.keys, keys, "right")
            hit = np.flatnonzero(high > low)
            if len(hit):
                count = (high - low)[hit]
                pairs.append((np.repeat(places[hit], count), rep.items[ragged(low[hit], count)]))
        for pieces in c.pieces:
            # A piece may begin before the first word of the window that holds an item.
            around = np.flatnonzero(held)
            keys = run_keys(flat, pieces.length)[around]
            low, high = np.searchsorted(pieces.keys, keys, "left"), np.searchsorted(pieces.keys, keys, "right")
            hit = np.flatnonzero(high > low)
            if len(hit):
                count = (high - low)[hit]
                at, own = np.repeat(around[hit], count), ragged(low[hit], count)
                first = begins[np.searchsorted(begins, at, side="right") - 1]
                pairs.append((np.maximum(at - pieces.offsets[own], first), pieces.items[own]))
    if not pairs:
        return []
    place, item = (np.concatenate(x) for x in zip(*pairs, strict=True))
    # The same passage is met from several places: one candidate for each run of as many words as
    # edits are allowed, looked at with that margin on both sides.
    step = index.limits[item] + 1
    number = np.searchsorted(begins, place, side="right") - 1
    merged = np.unique(np.stack([item, (place - begins[number]) // step, number]), axis=1)
    item, number = merged[0], merged[2]
    place = begins[number] + merged[1] * (index.limits[item] + 1)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for k in np.unique(item).tolist():
        own, limit, n = index.codes[k], int(index.limits[k]), len(index.codes[k])
        at, doc = place[item == k], number[item == k]
        width = n + 4 * limit + 1
        held = np.zeros(len(index.vocabulary) + 1, dtype=bool)
        held[own] = True
        for a in range(0, len(at), 4096):
            start = at[a : a + 4096] - limit
            regions = flat[start[:, None] + np.arange(width)]
            enough = held[regions].sum(axis=1) >= n - limit
            regions, start, docs = regions[enough], start[enough], doc[a : a + 4096][enough]
            if not len(regions):
                continue
            distance, end = edit_distances(own, regions)
            for d, far, last in zip(docs.tolist(), distance.tolist(), (start + end - begins[docs]).tolist(), strict=True):
                if far <= limit and (far, last) < best.get((d, k), (limit + 1, 0)):
                    best[d, k] = (far, last)
    return [(d, k, far, last) for (d, k), (far, last) in sorted(best.items())]


MATCHES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("distance", T.LongType()),
        T.StructField("item_words", T.LongType()),
        T.StructField("similarity", T.DoubleType()),
        T.StructField("end_word", T.LongType()),
    ]
)


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, bytes]]]:
    """The items, in blocks of at most BLOCK_WORDS words (or of one item), read one after another."""
    block, size = [], 0
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter("t IS NOT NULL")
    for row in rows.sort("i", "t").toLocalIterator():
        text = row.t.encode()
        n = len(words_of(text))
        if block and size + n > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((row.i, text))
        size += n
    yield block


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    rate: float = 0.2,
    recall: float = 0.98,
    seed: int = 9,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs of a row of ``docs`` and an item that the row's text holds: MATCHES.

    An item is held if some run of the text's words is within an edit distance (words inserted,
    deleted or replaced) of floor(rate * item words), that is at a similarity 1 - distance / words of
    0.8 or more by default.  ``recall``: share of simulated edits at that limit that must be found of
    every item; what is found is exact, and closer passages are found more surely.  ``end_word``: the
    first word after the closest passage.  Items without words, null texts and texts without words
    match nothing; repeated rows give repeated results; other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    result, last = None, None
    for block in item_blocks(items, item_id_col, item_text_col):
        if last is not None:  # one of several blocks: its matches are written and its index is let go
            result = written(result, "matches")
            last.destroy()
        index = last = spark.sparkContext.broadcast(build_index(block, rate, recall, seed))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                ix, ids = index.value, batch.column("doc_id").to_pylist()
                rows = [
                    (ids[d], ix.ids[k], far, len(ix.codes[k]), 1.0 - far / len(ix.codes[k]), last)
                    for d, k, far, last in search(ix, texts_of(batch, "text"))
                ]
                if rows:
                    kinds = [pa.int64()] * 4 + [pa.float64(), pa.int64()]
                    columns = [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=MATCHES.names)

        part = source.mapInArrow(run, MATCHES)
        result = part if result is None else result.unionByName(part)
    return result


def drop_leaks(
    docs: DataFrame,
    items: DataFrame,
    rate: float = 0.2,
    recall: float = 0.98,
    seed: int = 9,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` without the rows whose text holds an item (as find_leaks says); all columns kept.

    All blocks of items are tried in one pass over the documents.
    """
    kept = docs
    for block in item_blocks(items, item_id_col, item_text_col):
        index = docs.sparkSession.sparkContext.broadcast(build_index(block, rate, recall, seed))

        def clean(texts, index=index):
            hit = {d for d, *_ in search(index.value, texts)}
            return ([k not in hit for k in range(len(texts))],)

        flag = T.StructField("__clean", T.BooleanType())
        kept = append_columns(kept, text_col, clean, [flag], where="__clean").drop("__clean")
    return kept
