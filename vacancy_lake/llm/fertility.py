"""Quality rules on what public vocabularies make of a text: tokeniser fertility.

Words are split into the tokens of each of several public vocabularies, each word on its own, and
those of each distinct word are remembered per Python worker.  From them come, per vocabulary,
characters per token, the share of tokens that are single bytes of a longer character (byte
fallback), and the entropy of the text's tokens.  Each vocabulary has a band for the three in each
script; a text outside its script's band in any vocabulary is rejected.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import SPACES, Codes, append_columns, ragged
from .bpe import PATTERN

#: Characters counted as symbols (fixed values).
SYMBOLS = b"#*$%&|<>"
#: Distinct words that a worker remembers, and bytes of these: bounds on memory, not on results.
WORD_LIMIT, WORD_BYTES = 400_000, 8 << 20
#: First code points of script blocks, in order, and the script from there on (None: no letters).
BLOCKS = [
    (0x0000, None), (0x0041, "latin"), (0x005B, None), (0x0061, "latin"), (0x007B, None), (0x00C0, "latin"),
    (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "other"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0780, "other"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, None), (0x2C00, "other"), (0x3000, None), (0x3040, "cjk"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xE000, None), (0xF900, "cjk"), (0xFB00, "other"), (0xFE00, None),
    (0x20000, "cjk"), (0x323B0, None),
]
STARTS = np.array([start for start, _ in BLOCKS], dtype=np.uint32)
SCRIPTS = sorted({name for _, name in BLOCKS if name})
BLOCK_SCRIPT = np.array([SCRIPTS.index(name) if name else len(SCRIPTS) for _, name in BLOCKS])
#: Entropy that is enough for a text of any length, in bits.
ENOUGH_BITS = 4.5
#: By vocabulary and script: least and most characters per token, most share of fallback bytes, least
#: entropy as a share of the entropy of as many tokens that are all different.  "none": a text
#: without letters.  Set from what each vocabulary makes of plain prose in each script (the tests hold
#: such prose): about half the fertility below it and twice or more above, some 0.1 to 0.35 more
#: fallback bytes.  Of "other" scripts the piece vocabulary knows some (Georgian: no fallback) and some
#: not (Syriac: 0.89); the byte vocabulary knows none, so its share says nothing there.
BANDS = {
    "piece": {
        "latin": (1.2, 8.0, 0.10, 0.35), "greek": (0.5, 3.0, 0.30, 0.35), "cyrillic": (1.0, 6.0, 0.20, 0.35),
        "hebrew": (0.45, 3.0, 0.30, 0.35), "arabic": (0.5, 3.0, 0.30, 0.35), "indic": (0.45, 3.0, 0.35, 0.35),
        "thai": (0.5, 4.0, 0.35, 0.35), "cjk": (0.5, 3.0, 0.40, 0.35), "hangul": (0.45, 3.0, 0.35, 0.35),
        "none": (0.5, 8.0, 0.10, 0.35), "other": (0.45, 6.0, 0.50, 0.30),
    },
    "byte": {
        "latin": (1.2, 8.0, 0.10, 0.35), "greek": (0.8, 5.0, 0.30, 0.35), "cyrillic": (1.2, 7.0, 0.20, 0.35),
        "hebrew": (0.7, 4.0, 0.35, 0.35), "arabic": (0.7, 4.0, 0.30, 0.35), "indic": (0.4, 3.0, 0.50, 0.35),
        "thai": (0.5, 4.0, 0.40, 0.35), "cjk": (0.4, 3.0, 0.50, 0.35), "hangul": (0.5, 3.5, 0.40, 0.35),
        "none": (0.5, 8.0, 0.10, 0.35), "other": (0.25, 6.0, 1.00, 0.30),
    },
}


class Vocabulary:
    """Tokens of words in a public vocabulary: a sentencepiece model with byte fallback, or ranks of a
    byte-level vocabulary (a word is then read with the space before it)."""

    def __init__(self, path: str) -> None:
        if path.endswith(".tiktoken"):
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            coder = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda words: [coder.encode_ordinary(" " + w) for w in words]
            self.is_byte = np.zeros(max(ranks.values()) + 1, dtype=bool)
            self.is_byte[[rank for token, rank in ranks.items() if len(token) == 1 and token[0] > 127]] = True
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda words: model.encode(words, num_threads=1)
            self.is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
        self.clear()

    def clear(self) -> None:
        self.ids, self.lengths = array("i"), array("i")

    def add(self, words: list[str]) -> None:
        for ids in self.encode(words):
            self.ids.fromlist(ids)
            self.lengths.append(len(ids))


class WordMeasures:
    """Tokens of the words a worker has met, in each vocabulary."""

    def __init__(self, paths: tuple[str, ...]) -> None:
        self.vocabularies = [Vocabulary(path) for path in paths]
        self.codes, self.held = Codes(), 0

    def look_up(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Codes of the words of each text, by which every vocabulary has their tokens."""
        if len(self.codes) > WORD_LIMIT or self.held > WORD_BYTES:
            self.codes, self.held = Codes(), 0
            for v in self.vocabularies:
                v.clear()
        look = self.codes.__getitem__
        codes = [np.array(list(map(look, words)), dtype=np.int64) for words in texts]
        if self.codes.fresh:
            new = [w.decode("utf-8") for w in self.codes.fresh]
            self.held += sum(map(len, self.codes.fresh))
            for v in self.vocabularies:
                v.add(new)
            self.codes.fresh = []
        return codes


@lru_cache(maxsize=2)
def measures(paths: tuple[str, ...]) -> WordMeasures:
    return WordMeasures(paths)


def outside(chars: int, tokens: int, share: float, bits: float, band: tuple) -> str | None:
    """The first of the three measures that lies outside the band."""
    low, high, most, least = band
    if not low <= chars / tokens <= high:
        return "fertility"
    if share > most:
        return "byte_fallback"
    return "entropy" if bits < min(least * np.log2(tokens), ENOUGH_BITS) else None


def repeated_words(codes: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more; ``codes`` stand for the words."""
    n = len(codes)
    if n < 4:
        return 0
    if int(codes.max()) >= 1 << 21:
        codes = np.unique(codes, return_inverse=True)[1]
    pairs = (codes[:-1] << 21 | codes[1:]) if n < 1 << 21 else np.unique(codes[:-1] * n + codes[1:], return_inverse=True)[1]
    windows = (pairs[:-1] << 21 | codes[2:]) if n < 1 << 21 else pairs[:-1] * n + codes[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    found = np.union1d(order[1:][same], order[:-1][same])
    for k in range(3):
        twice[found + k] = True
    return int(twice.sum())


def main_script(text: bytes) -> str:
    """The script of most letters, by code-point blocks; ``none`` without letters."""
    if text.isascii():
        return "latin" if any(map(text.lower().__contains__, range(0x61, 0x7B))) else "none"
    points = np.frombuffer(text.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    counts = np.bincount(BLOCK_SCRIPT[np.searchsorted(STARTS, points, side="right") - 1], minlength=len(SCRIPTS) + 1)
    return SCRIPTS[int(counts[:-1].argmax())] if counts[:-1].any() else "none"


def entropy(ids: np.ndarray) -> float:
    """Of the tokens of one text, in bits."""
    ids = np.sort(ids)
    edges = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1], [True]]))
    counts = np.diff(edges)
    return float(np.log2(len(ids)) - (counts * np.log2(counts)).sum() / len(ids))


def judge(texts: list[bytes | None], paths: dict[str, str], bands: dict) -> list[tuple]:
    """One row of ``fields`` per text."""
    m = measures(tuple(paths.values()))
    rows = []
    for at in range(0, len(texts), 256):
        part = [x or b"" for x in texts[at : at + 256]]
        words = [x.split() for x in part]
        codes = m.look_up(words)
        tables = []
        for v in m.vocabularies:
            lengths = np.array(v.lengths, dtype=np.int64)
            tables.append((np.array(v.ids, dtype=np.int32), np.cumsum(lengths) - lengths, lengths, v.is_byte))
        for text, own, c in zip(part, words, codes, strict=True):
            solid = text.translate(None, SPACES)
            chars = len(solid.decode("utf-8"))
            symbols = len(text) - len(text.translate(None, SYMBOLS))
            lines = [x for x in text.split(b"\n") if x.translate(None, SPACES)]
            repeats = repeated_words(c)
            n = len(own)
            failed = n < 50 or 100 * repeats > 50 * n
            script = main_script(text)
            values, reason = [], None if n else "empty"
            for name, (ids, starts, lengths, is_byte) in zip(paths, tables, strict=True):
                tokens = ids[ragged(starts[c], lengths[c])]
                if not len(tokens):
                    values += [0, 0.0, 0.0, 0.0]
                    continue
                share, bits = float(is_byte[tokens].mean()), entropy(tokens)
                values += [len(tokens), chars / len(tokens), share, bits]
                wrong = outside(chars, len(tokens), share, bits, bands[name].get(script, bands[name]["other"]))
                reason = reason or (wrong and f"{name}: {wrong}")
            dup = len(lines) - len(set(lines))
            rows.append((n, chars, symbols, dup, repeats, failed, not failed and reason is None, script, reason, *values))
    return rows


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
    T.StructField("script", T.StringType()),
    T.StructField("reason", T.StringType()),
]


def fields(names: Sequence[str]) -> list[T.StructField]:
    """Columns of the result, four for each vocabulary."""
    each = [("tokens", T.LongType()), ("chars_per_token", T.DoubleType()), ("byte_share", T.DoubleType()), ("entropy", T.DoubleType())]
    return FIELDS + [T.StructField(f"{name}_{c}", kind) for name in names for c, kind in each]


def quality_rules(
    docs: DataFrame, paths: dict[str, str], bands: dict = BANDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: id and ``fields``.

    ``paths``: public vocabulary files by name; ``bands``: by the same names, then by script.
    ``kept`` is false if ``base_failed`` or if the text lies outside its script's band in any
    vocabulary; ``reason`` names the first vocabulary and measure.  A null or empty text has no words:
    it fails the base rule, has script ``none`` and zero for every measure.  Repeated rows give
    repeated results, other columns are not read, an empty table gives an empty result.
    """

    def compute(texts):
        return list(zip(*judge(texts, paths, bands), strict=True))

    return append_columns(docs, text_col, compute, fields(list(paths)), [id_col])
