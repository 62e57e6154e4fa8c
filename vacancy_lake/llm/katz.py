"""Katz backoff: Good-Turing discounts, exactly normalised backoff weights, scores of whole texts.

    P(w | h) = d(r) r / c(h)          if the pair (h, w) was seen r > 0 times,
             = alpha(h) P(w)          if not, and P(w) if h was not seen at all,
    P(w)     = d1(c) c / N            if w was seen c > 0 times, else the mass that this leaves.

A word sequence costs one log10 P per word and one for its end.  Tables of n-grams grow with the
corpus and are never whole in one place:

1. words are counted; the table is partitioned by word and written;
2. pairs are counted where their second word lives.  Tasks send each bucket of words one packed block
   of pairs with the documents that have them, so pair counts, word counts and all of a document's
   terms that depend on (h, w) or on c(w) are known in the bucket.  Since every seen history occurs
   as a word, the terms -log c(h) are taken there, too;
3. what is left depends on h alone: the mass of unseen words, of those documents that met one.  The
   bucket of h gathers the counts of h by r and the sum of P(w) over its seen words, and the table of
   histories is written.  When all counts of counts are known, alpha(h) follows exactly.

Words stand for their 64-bit hashes.  A word with a large share of all tokens has its pairs spread
by both words and, as a history, its unseen pairs by block; there are few such words by construction,
and their counts are sent to all tasks.  Texts' terms are dealt by a hash of their block.  The number
of buckets grows with the input, so that a bucket's pairs fit in one task.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import Codes, texts_of
from .store import written

#: Counts up to K get Good-Turing discounts.  Larger ones lose LITTLE of an occurrence, so that every
#: history keeps some mass for unseen words.
K = 5
LITTLE = 0.01
#: Tokens of one block, and most tokens of a bucket (about; a token takes six bytes of text).
BLOCK_TOKENS = 2_000_000
BUCKET_TOKENS = 4_000_000
#: A word with over 1 / (HOT * buckets) of all tokens is spread: at most HOT * buckets words are.
HOT = 8


def key_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


#: Words are never empty and never hold a space, so these two are no word's.
END, START = key_of(b""), key_of(b" ")


def discounts(n: list[int]) -> np.ndarray:
    """d(0..K) from the numbers n[1..K+1] of types that were seen once, twice, ...

    Good-Turing with smoothed numbers (Zipf's line through log n[r] over log r, as in simple
    Good-Turing; each number gets 1 / r^2 of a type more, so that there is a line for small tables,
    too), then Katz's formula, which leaves counts over K as they are.  With the line's slope below
    -1 all discounts lie in (0, 1).
    """
    r = np.arange(1, K + 2)
    slope = np.polyfit(np.log(r), np.log(np.array(n[1 : K + 2]) + 1.0 / r**2), 1)[0]
    power = min(slope + 1, -0.05)
    whole = float(K + 1) ** power
    d = np.ones(K + 1)
    d[1:] = ((1 + 1 / r[:K]) ** power - whole) / (1 - whole)
    return d


@dataclass
class Words:
    """What every task must know of single words."""

    tokens: int  # N
    types: int  # V
    texts: int  # training texts
    d: np.ndarray
    unseen: float  # P of a word that was not seen
    hot: dict[int, int]
    buckets: int

    def probability(self, c: np.ndarray) -> np.ndarray:
        kept = np.where(c > K, c - LITTLE, c * self.d[np.minimum(c, K)])
        return np.where(c > 0, kept / max(1, self.tokens), self.unseen)


def tokenise(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys by code (0: start, 1: end), codes of all tokens with each text's end, tokens per text."""
    codes = Codes()
    codes.update({b" ": 0, b"": 1})
    look = codes.__getitem__
    parts, counts = [], []
    for text in texts:
        words = (text or b"").lower().split()
        words.append(b"")
        parts.append(np.array(list(map(look, words)), dtype=np.int64))
        counts.append(len(words))
    keys = np.array([START, END, *map(key_of, codes.fresh)], dtype=np.uint64)
    return keys, np.concatenate(parts) if parts else np.empty(0, np.int64), np.array(counts, dtype=np.int64)


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about BLOCK_TOKENS tokens (six bytes each)."""
    sizes = batch.column("text").cast(pa.large_binary()).fill_null(b"")
    lengths = np.diff(np.frombuffer(sizes.buffers()[1], dtype=np.int64)[sizes.offset : sizes.offset + len(sizes) + 1])
    begin, total = 0, 0
    for k, n in enumerate(lengths.tolist()):
        total += n
        if total >= 6 * BLOCK_TOKENS:
            yield begin, k + 1
            begin, total = k + 1, 0
    if begin < len(lengths):
        yield begin, len(lengths)


def small(values: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest unsigned type."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def pack(*arrays) -> bytes:
    return pickle.dumps(arrays, protocol=5)


def count_words(docs: DataFrame) -> DataFrame:
    """key, n: tokens of the training rows (columns text, held)."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, "text")
            for a, b in blocks(batch):
                keys, codes, _ = tokenise(texts[a:b])
                n = np.bincount(codes, minlength=len(keys))
                seen = np.flatnonzero(n)
                columns = [pa.array(keys[seen].view(np.int64)), pa.array(n[seen].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n"])

    return docs.filter(~F.col("held")).select("text").mapInArrow(run, schema).groupBy("key").agg(F.sum("n").alias("n"))


def word_statistics(words: DataFrame, buckets: int) -> Words:
    counts = [F.count_if(F.col("n") == r) for r in range(1, K + 2)]
    end = F.sum(F.when(F.col("key") == np.uint64(END).astype(np.int64).item(), F.col("n")))
    row = words.agg(F.sum("n"), F.count("*"), end, *counts).first()
    tokens, types, texts = row[0] or 0, row[1], row[2] or 0
    d = discounts([0, *row[3:]])
    # The mass that discounting leaves is that of all unseen words together.
    taken = F.lit(0.0)
    for r in range(1, K + 1):
        taken = F.when(F.col("n") == r, F.lit(float(r * (1 - d[r])))).otherwise(taken)
    left = words.agg(F.sum(F.when(F.col("n") > K, F.lit(LITTLE)).otherwise(taken))).first()[0]
    least = tokens / (HOT * buckets)
    hot = {int(np.int64(r.key).astype(np.uint64)): r.n for r in words.filter(F.col("n") > least).collect()}
    hot[START] = 0  # no token, but the history of as many as there are texts
    return Words(tokens, types, texts, d, left / tokens if tokens else 1.0, hot, buckets)


PAIRS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("payload", T.BinaryType())])
#: Kinds of rows on the way: terms of a block's texts, counts of histories, pairs that were not seen.
TEXTS, HISTORIES, UNSEEN, COUNTS = range(4)


def bucket_of(w: np.ndarray, h: np.ndarray, words: Words) -> np.ndarray:
    """Where a pair is counted: by its second word, by both if that is hot."""
    both = (h ^ (w >> np.uint64(17))) * np.uint64(0x9E3779B97F4A7C15)
    spread = np.where(is_hot(w, words), both, w)
    return ((spread >> np.uint64(20)) % np.uint64(words.buckets)).astype(np.int64)


def history_bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def block_bucket(block, buckets: int):
    """Where the terms of a block's texts meet."""
    mixed = np.asarray(block).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def is_hot(h: np.ndarray, words: Words) -> np.ndarray:
    return np.isin(h, np.fromiter(words.hot, dtype=np.uint64, count=len(words.hot)))


def block_rows(ids: list, held: np.ndarray, texts: list, block: int, words: Words) -> Iterator[tuple]:
    """Of one block: a row with its texts, and for each bucket a row with the pairs counted there.

    Pairs are sorted by second word, then first; every pair is followed by the texts that have it.
    """
    keys, codes, counts = tokenise(texts)
    n = len(texts)
    yield words.buckets + int(block_bucket(block, words.buckets)), block, pack(ids, held, small(counts))
    begins = np.cumsum(counts) - counts
    first = np.empty_like(codes)
    first[1:] = codes[:-1]
    first[begins] = 0
    size = len(keys)
    first += codes * size
    first *= n
    first += np.repeat(np.arange(n), counts)
    del codes
    entries, times = np.unique(first, return_counts=True)
    pair, text = np.divmod(entries, n)
    del entries
    text, times = small(text), small(times)
    second, first = (x.astype(np.int32) for x in np.divmod(pair, size))
    bucket = bucket_of(keys[second], keys[first], words).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(words.buckets + 1))
    bits = np.packbits(held)
    for b in range(words.buckets):
        at = order[edges[b] : edges[b + 1]]
        if not len(at):
            continue
        p = pair[at]
        new = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        w, w_pairs = np.unique(second[at][new], return_counts=True)
        h, h_place = np.unique(first[at][new], return_inverse=True)
        per_pair = np.diff(np.append(new, len(at)))
        yield b, block, pack(n, bits, keys[w], small(w_pairs), keys[h], small(h_place), small(per_pair), small(text[at]), small(times[at]))


def send_pairs(docs: DataFrame, words) -> DataFrame:
    """Rows of PAIRS from all texts (columns id, text, held)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32  # the same for a task that runs again
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), texts_of(batch, "text")
            held = np.array(batch.column("held").to_pylist(), dtype=bool)
            for a, b in blocks(batch):
                rows = list(block_rows(ids[a:b], held[a:b], texts[a:b], block, words.value))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary()), strict=True)], names=PAIRS.names)
                block += 1

    return docs.mapInArrow(run, PAIRS)


SENT = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("payload", T.BinaryType())])
ARROW_SENT = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])


def sent(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.table([pa.array(c, type=f.type) for c, f in zip(columns, ARROW_SENT, strict=True)], schema=ARROW_SENT)


def grouped_sum(order: np.ndarray, edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values[order], edges) if len(order) else values[:0]


def history_rows(h: np.ndarray, r: np.ndarray, p: np.ndarray, buckets: int) -> list[tuple]:
    """Of each first word: pairs by r, and the sum of P(w) over its seen second words."""
    order = np.argsort(h, kind="stable")
    hs, rs, ps = h[order], r[order], p[order]
    edges = np.flatnonzero(np.concatenate([[True], hs[1:] != hs[:-1]]))
    by_r = [small(np.add.reduceat((rs == k).astype(np.int64), edges)) for k in range(1, K + 2)]
    by_r += [small(np.add.reduceat((rs > K).astype(np.int64), edges)), small(np.add.reduceat(rs * (rs > K), edges))]
    mass, keys = np.add.reduceat(ps, edges), hs[edges]
    to = history_bucket(keys, buckets)
    rows = []
    for b in np.unique(to).tolist():
        m = to == b
        rows.append((b, HISTORIES, -1, pack(keys[m], mass[m], [small(x[m]) for x in by_r])))
    return rows


def count_pairs(payloads: list[tuple[int, bytes]], words: Words) -> list[tuple]:
    """One bucket's pairs counted over all blocks: terms of the texts, histories, unseen pairs."""
    loaded = []
    while payloads:  # a bucket's packed pairs go as they are unpacked
        block, packed = payloads.pop()
        loaded.append((block, pickle.loads(packed)))
    w = np.concatenate([np.repeat(x[2], x[3]) for _, x in loaded])
    h = np.concatenate([x[4][x[5]] for _, x in loaded])
    trained = []
    for _, (n, bits, _, _, _, _, per_pair, text, times) in loaded:
        counts = times * ~np.unpackbits(bits, count=n).astype(bool)[text]
        starts = np.cumsum(per_pair, dtype=np.int64) - per_pair
        trained.append(np.add.reduceat(counts.astype(np.int64), starts))
    loaded = [(block, (x[0], *x[6:])) for block, x in loaded]
    # r of each pair, c of each second word.
    order = np.lexsort((h, w))
    sw, sh = w[order], h[order]
    edges = np.flatnonzero(np.concatenate([[True], (sw[1:] != sw[:-1]) | (sh[1:] != sh[:-1])]))
    w_once, h_once = sw[edges], sh[edges]
    inner = w != np.uint64(END)
    del w, sw, sh
    r_once = grouped_sum(order, edges, np.concatenate(trained))
    del trained
    w_edges = np.flatnonzero(np.concatenate([[True], w_once[1:] != w_once[:-1]]))
    c_word = np.add.reduceat(r_once, w_edges)
    for k, key in enumerate(w_once[w_edges].tolist()):
        if key in words.hot:
            c_word[k] = words.hot[key]
    c_once = np.repeat(c_word, np.diff(np.append(w_edges, len(edges))))
    seen = np.flatnonzero(r_once > 0)
    rows = history_rows(h_once[seen], r_once[seen], words.probability(c_once[seen]), words.buckets) if len(seen) else []
    del w_once, h_once, seen
    sizes = np.diff(np.append(edges, len(order)))
    r, c = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    r[order], c[order] = np.repeat(r_once, sizes), np.repeat(c_once, sizes)
    del order, edges, sizes, r_once, c_once
    # Terms of the texts, all but d(r), which is not known yet: how many pairs have r = 1..K is sent.
    term = np.where(r > K, r - LITTLE, np.maximum(r, 1))
    new = r == 0
    term[new] = words.probability(c[new])
    np.log10(term, out=term)
    known = (c > 0) & inner
    term[known] -= np.log10(c[known])
    base = np.log10(c + 1.0)
    r = np.minimum(r, K + 1).astype(np.int8)
    missing: list[tuple] = []
    at = 0
    for block, (n, per_pair, text, times) in loaded:
        own = slice(at, at + len(per_pair))
        at += len(per_pair)
        each = np.repeat(np.arange(own.start, own.stop), per_pair)
        times = times.astype(np.int64)
        def total(values):
            return np.bincount(text, times * values, n)

        by_r = [small(total(r[each] == k).astype(np.int64)) for k in range(1, K + 1)]
        found = small(total(c[each] > 0).astype(np.int64))
        payload = pack(total(base[each]), total(term[each]), found, by_r)
        rows.append((int(block_bucket(block, words.buckets)), TEXTS, block, payload))
        zero = np.flatnonzero(r[each] == 0)
        if len(zero):
            missing.append((h[each[zero]], np.full(len(zero), block), text[zero].astype(np.int64), times[zero]))
    if missing:
        mh, mb, mt, mn = (np.concatenate(x) for x in zip(*missing, strict=True))
        to = history_bucket(mh, words.buckets)
        spread = is_hot(mh, words)
        to[spread] = block_bucket(mb[spread], words.buckets)
        for b in np.unique(to).tolist():
            m = np.flatnonzero(to == b)
            uh, place = np.unique(mh[m], return_inverse=True)
            ub, block = np.unique(mb[m], return_inverse=True)
            rows.append((b, UNSEEN, -1, pack(uh, small(place), ub, small(block), small(mt[m]), small(mn[m]))))
    return rows


def merge_texts(rows: list[bytes], own: bytes) -> bytes:
    """Sum of all terms of a block's texts."""
    ids, held, counts = pickle.loads(own)
    n = len(ids)
    base, score, known, by_r = np.zeros(n), np.zeros(n), np.zeros(n, np.int64), np.zeros((K, n), np.int64)
    for payload in rows:
        b, s, k, r = pickle.loads(payload)
        base += b
        score += s
        known += k
        for i in range(K):
            by_r[i] += r[i]
    return pack(ids, held, counts, base, score, known, by_r)


#: Sums of a history: pairs by r = 1..K, pairs of more and their counts, P(w) of its seen words.
SUMS = K + 3


def history_sums(loaded: list, wanted: np.ndarray) -> np.ndarray:
    """SUMS x ``wanted`` (sorted histories) from this bucket's parts."""
    sums = np.zeros((SUMS, len(wanted)))
    for keys, mass, by_r in loaded if len(wanted) else ():
        place = np.searchsorted(wanted, keys)
        place[place == len(wanted)] = 0
        own = np.flatnonzero(wanted[place] == keys)
        for k, values in enumerate([*by_r[:K], by_r[K + 1], by_r[K + 2], mass]):
            np.add.at(sums[k], place[own], values[own])
    return sums


def merge_histories(counted: list[bytes], unseen: list[bytes], words: Words) -> tuple[bytes, bytes | None]:
    """Of this bucket: numbers of pairs by r (1..K+1) and the sums of its hot histories; the unseen
    pairs with the sums of their histories, hot ones (whose sums are in another bucket) apart."""
    loaded = [pickle.loads(p) for p in counted]
    totals = [int(sum(x[2][k].sum(dtype=np.int64) for x in loaded)) for k in range(K + 1)]
    known = np.unique(np.concatenate([x[0] for x in loaded])) if loaded else np.empty(0, np.uint64)
    hot = known[is_hot(known, words)]
    head = pack(totals, hot, history_sums(loaded, hot))
    if not unseen:
        return head, None
    missing = [pickle.loads(p) for p in unseen]
    needed = np.unique(np.concatenate([x[0] for x in missing]))
    places = [
        (np.searchsorted(needed, x[0])[x[1]], x[2][x[3]], x[4], x[5]) for x in missing
    ]
    place, block, text, times = (np.concatenate([x[k] for x in places]) for k in range(4))
    return head, pack(needed, history_sums(loaded, needed), small(place), block, small(text), small(times))


def backoff_terms(payload: bytes, d: np.ndarray, hot: dict[int, np.ndarray], buckets: int) -> list[tuple]:
    """log10(alpha(h) c(h)) of the unseen pairs, summed over each text: rows of block and payload."""
    histories, sums, place, block, text, times = pickle.loads(payload)
    for k, h in enumerate(histories.tolist()):
        if h in hot:
            sums[:, k] = hot[h]
    r = np.arange(1, K + 1)
    c = (sums[:K] * r[:, None]).sum(axis=0) + sums[K + 1]
    kept = (sums[:K] * (r * d[1:])[:, None]).sum(axis=0) + sums[K + 1] - LITTLE * sums[K]
    # alpha c = (c - kept) / (1 - sum of P(w)); an unseen history has alpha 1 and no c.
    with np.errstate(divide="ignore", invalid="ignore"):
        term = np.where(c > 0, np.log10((c - kept) / (1.0 - sums[K + 2])), 0.0)
    values = term[place] * times
    rows = []
    for b in np.unique(block).tolist():
        m = block == b
        own, where = np.unique(text[m], return_inverse=True)
        rows.append((int(block_bucket(b, buckets)), UNSEEN, int(b), pack(own, np.bincount(where, values[m]))))
    return rows


SCORES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])


def final_scores(texts: bytes, terms: list[bytes], words: Words, d: np.ndarray) -> pa.Table:
    ids, held, counts, base, score, known, by_r = pickle.loads(texts)
    counts = counts.astype(np.int64)
    score = score + (by_r * np.log10(d[1:])[:, None]).sum(axis=0)
    if words.texts:
        score -= np.log10(words.texts)  # the first word's history is the start of a text
    for payload in terms:
        own, values = pickle.loads(payload)
        score[own] += values
    base = base - counts * np.log10(words.tokens + words.types + 1.0)
    columns = [pa.array(ids, pa.int64()), pa.array(held), pa.array(counts), pa.array(known), pa.array(np.full(len(ids), words.tokens)), pa.array(base), pa.array(score)]
    return pa.table(columns, names=SCORES.names)


def katz_scores(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: SCORES, of a bigram model learned from the rows that are not ``held``.

    ``score`` is the model's log10 probability of the text with its end, ``base_score`` that of
    add-one single words.  A null or empty text is just its end.  ``held`` must not be null.  Repeated
    rows count and are scored each; other columns are not read; without training rows every word is
    unseen and has probability 1 (there is nothing to tell them apart).
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), held.alias("held"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (6 * BUCKET_TOKENS)))
    stats = word_statistics(written(count_words(source), "words"), buckets)
    words = spark.sparkContext.broadcast(stats)

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = list(zip(table.column("block").to_pylist(), table.column("payload").to_pylist(), strict=True))
        if key[0].as_py() >= words.value.buckets:  # texts of blocks pass through
            return sent([(int(block_bucket(b, words.value.buckets)), COUNTS, b, p) for b, p in rows])
        return sent(count_pairs(rows, words.value))

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        by_kind: dict[int, list] = {k: [] for k in range(4)}
        for kind, block, payload in zip(*(table.column(c).to_pylist() for c in ("kind", "block", "payload")), strict=True):
            by_kind[kind].append((block, payload))
        terms: dict[int, list] = {}
        for block, payload in by_kind[TEXTS]:
            terms.setdefault(block, []).append(payload)
        out = [(0, TEXTS, block, merge_texts(terms.get(block, []), own)) for block, own in by_kind[COUNTS]]
        head, needed = merge_histories([p for _, p in by_kind[HISTORIES]], [p for _, p in by_kind[UNSEEN]], words.value)
        out.append((0, COUNTS, -1, head))
        if needed is not None:
            out.append((0, HISTORIES, -1, needed))
        return sent(out)

    counted = send_pairs(source, words).groupBy("bucket").applyInArrow(count, SENT)
    tables = written(counted.groupBy("bucket").applyInArrow(merge, SENT), "histories")
    totals = np.zeros(K + 1, dtype=np.int64)
    hot: dict[int, np.ndarray] = {}
    for row in tables.filter(F.col("kind") == COUNTS).select("payload").toLocalIterator():  # one per bucket
        counts, keys, sums = pickle.loads(row.payload)
        totals += np.array(counts)
        hot |= {h: sums[:, k] for k, h in enumerate(keys.tolist())}
    d = discounts([0, *totals.tolist()])
    back_off = spark.sparkContext.broadcast(hot)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                yield from sent(backoff_terms(payload, d, back_off.value, buckets)).to_batches()

    def finish(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = list(zip(table.column("kind").to_pylist(), table.column("payload").to_pylist(), strict=True))
        texts = [p for k, p in rows if k == TEXTS]
        return final_scores(texts[0], [p for k, p in rows if k == UNSEEN], words.value, d)

    texts = tables.filter(F.col("kind") == TEXTS)
    terms = tables.filter(F.col("kind") == HISTORIES).select("payload").mapInArrow(back, SENT)
    return texts.unionByName(terms).groupBy("block").applyInArrow(finish, SCORES)
