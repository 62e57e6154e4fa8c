"""What a worker remembers is bounded in bytes, and bounds change no result."""

import random
import tracemalloc

import numpy as np

from vacancy_lake.llm import bpe, fertility, language, records
from vacancy_lake.llm.queries import vocabulary

PATH = vocabulary("byte_bpe_50k.json")


def unspaced(n, length=300, seed=1):
    run = "".join(map(chr, np.random.default_rng(seed).integers(0x4E00, 0x9FA0, n + length)))
    for k in range(n):
        yield run[k : k + length]


def test_a_hundred_thousand_unspaced_texts_stay_below_220_mb():
    cache = bpe.PieceCache([], lambda pieces: [x.encode() * 2 for x in pieces])
    batch = []
    tracemalloc.start()
    try:
        for text in unspaced(100_000):
            batch.append(text)
            if len(batch) == 256:
                for pieces, own in zip(cache.of(batch), batch, strict=True):
                    assert b"".join(pieces) == own.encode() * 2
                batch = []
        peak = tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()
    assert peak < 220, peak


def test_small_bounds_give_the_same_ids(monkeypatch):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(PATH)
    rng = random.Random(2)
    words = ["alpha", "beta,", "dữ", "x" * 50, *unspaced(3, 80), "  ", "\n", "<s>", "don't"]
    texts = [" ".join(rng.choices(words, k=12)) for _ in range(100)] + list(unspaced(5)) + ["", "y" * 3000]
    want = [own.encode(t, add_special_tokens=False).ids for t in texts]
    t = bpe.BytePairTable(PATH)
    library = records.library_cache(PATH, "<i4")
    for weight in (0, 20_000):
        for encode in (lambda pieces: list(map(t.encode_piece, pieces)), library.encode):
            cache = bpe.PieceCache(list(t.special), encode, weight=weight)
            got = [np.frombuffer(b"".join(p), dtype=np.int32).tolist() for at in range(0, len(texts), 16) for p in cache.of(texts[at : at + 16])]
            assert got == want
    assert t.remembered.cache_info().currsize < 200


def test_words_are_let_go_by_their_bytes(monkeypatch):
    measures = fertility.WordMeasures((vocabulary("piece_bpe_32k.model"),))
    monkeypatch.setattr(fertility, "WORD_BYTES", 10_000)
    texts = [t.encode() for t in unspaced(60, 40)]
    for t in texts:
        measures.look_up([[t]])
        assert measures.held <= 10_000 + len(t) and len(measures.codes) <= 10_000 // len(t) + 2
    scores = language.WordScores()

    class Flat:
        labels = ["a"]

        def scores(self, words):
            return np.array([[len(w)] for w in words], dtype=float)

    monkeypatch.setattr(language, "WORD_LETTERS", 100)
    for n in range(1, 60):
        assert scores.look_up(Flat(), [["w" * n, "w"]])[:, 0].tolist() == [n, 1]
        assert len(scores.codes) < 40
