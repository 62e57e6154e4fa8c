"""BPE encoding by backtracking over longest token matches, and decoding with an offset table.

A sequence of tokens is what the merges would give if, and only if, every two neighbours are
compatible: merging the text of the pair on its own gives the pair back.  So the encoder walks from
left to right, takes the longest token an Aho-Corasick automaton finds at a position, checks it
against its left neighbour, falls back to the next shorter token and at last takes back the
neighbour; positions from which no way led on are not tried again.  That is linear in the text.

Texts are cut at white space first (no token of a pre-tokenised vocabulary crosses those cuts), and
the ids of each distinct piece are remembered per Python worker, so most of a text is table look-ups.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import Codes, append_columns, ragged

#: Characters with the Unicode property White_Space (fixed values).
WHITE = r"\t-\r \x85\xa0  -     　"
#: Letters of a range in which every character is a letter.
LATIN = "A-Za-zÀ-ÖØ-öø-ʯ"
#: Cuts that the pre-tokeniser never crosses: a run of letters before ASCII or the end, with an
#: optional space; else an optional space and what is not space; else space.
PIECES = re.compile(rf" ?[{LATIN}]++(?![^\x00-\x7f])| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
ONE_WORD = re.compile(rf" ?[{LATIN}]+").fullmatch
#: The pre-tokeniser of the byte-level vocabularies (fixed pattern).
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+"
    rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
#: Distinct pieces a worker remembers: a bound on memory, not on results.
PIECE_LIMIT = 300_000
#: What the remembered pieces may weigh: characters of names (two bytes each), ids, and 200 bytes an entry.  Spaced
#: text reaches PIECE_LIMIT first; text without spaces, whose pieces are whole paragraphs, reaches this.
PIECE_BYTES = 96 << 20
#: Words inside of pieces that are remembered beside, and the length of the longest of them.
INNER_LIMIT, INNER_CHARS = 100_000, 32


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary file: printable Latin-1
    characters stand for themselves, the other bytes, in order, for the characters from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BytePairTable:
    """A byte-level vocabulary: bytes of each id, pairs that merge, and how each token was made."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_alphabet()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        for text, i in ids.items():
            self.tokens[i] = bytes(letter[c] for c in text)
        for text, i in self.special.items():
            self.tokens[i] = text.encode()
        # Rank of a token = place of the merge that makes it; bytes rank first.
        self.rank = [0] * size
        self.halves = [(i, i) for i in range(size)]
        self.merged: dict[tuple[int, int], int] = {}
        for n, (left, right) in enumerate(spec["model"]["merges"], 1):
            a, b, c = ids[left], ids[right], ids[left + right]
            self.merged[a, b] = c
            if self.halves[c] == (c, c):
                self.halves[c], self.rank[c] = (a, b), n
        self.exact = {self.tokens[i]: i for i in ids.values() if self.whole(i)}
        self.automaton = ahocorasick.Automaton()
        for i in ids.values():
            self.automaton.add_word(self.tokens[i].decode("latin-1"), i)
        self.automaton.make_automaton()
        #: The longest token that a token begins with, itself apart; -1: none.
        by_bytes = {self.tokens[i]: i for i in ids.values()}
        self.shorter = [-1] * size
        for token, i in by_bytes.items():
            self.shorter[i] = next((by_bytes[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in by_bytes), -1)
        self.decimal = [str(i).encode() for i in range(size)]
        self.compatible: dict[tuple[int, int], bool] = {}
        self.remembered = lru_cache(INNER_LIMIT)(self.word_ids)
        self.split = regex.compile(PATTERN).findall
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        # Decoding: all token bytes in one block, and where each id begins.
        self.sizes = [len(t) for t in self.tokens]
        self.lengths = np.array(self.sizes, dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.block = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)

    def fits(self, left: int, right: int) -> bool:
        """True if merging the bytes of ``left`` and ``right`` gives these two tokens.

        Undo the latest merges on both sides of the border, latest first: if a pair that touches at
        the border would have merged before the merge just undone, the border would be gone.
        """
        if len(self.compatible) > 1_000_000:
            self.compatible.clear()
        known = self.compatible[left, right] = self._fits(left, right)
        return known

    def _fits(self, a: int, b: int) -> bool:
        rank, halves, merged = self.rank, self.halves, self.merged
        # The border pair exists while neither side has grown beyond it; it merges at ``when`` and
        # that comes before the next growth at rank ``next_growth`` (ties: the left one goes first).
        next_growth, tie_lost = len(rank) + 1, False
        while True:
            c = merged.get((a, b))
            if c is not None and (rank[c] < next_growth or (tie_lost and rank[c] == next_growth)):
                return False
            if not rank[a] and not rank[b]:
                return True
            if rank[a] > rank[b]:
                next_growth, tie_lost, a = rank[a], False, halves[a][1]
            else:
                next_growth, tie_lost, b = rank[b], True, halves[b][0]

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one pre-token, as its merges give them."""
        if (token := self.exact.get(word)) is not None:
            return [token]
        size, sizes, compatible, shorter = len(word), self.sizes, self.compatible, self.shorter
        longest = [0] * size  # token by start: of those found at a place the last is the longest
        for end, token in self.automaton.iter(word.decode("latin-1")):
            longest[end + 1 - sizes[token]] = token
        out: list[int] = []
        dead = set()
        at, token = 0, longest[0]
        while True:
            if token < 0:  # no way on from here with this neighbour
                dead.add(at)
                token = out.pop()
                at -= sizes[token]
                token = shorter[token]
                continue
            end = at + sizes[token]
            if end in dead:
                token = shorter[token]
                continue
            if out:
                pair = out[-1], token
                if (fits := compatible.get(pair)) is None:
                    fits = self.fits(*pair)
                if not fits:
                    token = shorter[token]
                    continue
            out.append(token)
            if end == size:
                return out
            at, token = end, longest[end]

    def whole(self, token: int) -> bool:
        """True if merging the token's own bytes gives that token."""
        a, b = self.halves[token]
        return a == b == token or (self.whole(a) and self.whole(b) and self.fits_until(a, b, token))

    def fits_until(self, a: int, b: int, token: int) -> bool:
        """The border of the two halves stays until the merge that makes ``token``."""
        known = self.merged.pop((a, b))
        try:
            return self._fits(a, b)
        finally:
            self.merged[a, b] = known

    def word_ids(self, word: str) -> bytes:
        return array("i", self.encode_word(word.encode())).tobytes()

    def encode_piece(self, piece: str) -> bytes:
        """Ids, as 32-bit integers, of a piece that was cut at white space."""
        if piece in self.special:
            return array("i", [self.special[piece]]).tobytes()
        if ONE_WORD(piece):
            return self.remembered(piece) if len(piece) <= INNER_CHARS else self.word_ids(piece)
        parts = [[x] if ONE_WORD(x) else self.split(x) for x in PIECES.findall(piece)]
        known, other = self.remembered, self.word_ids
        return b"".join([known(word) if len(word) <= INNER_CHARS else other(word) for words in parts for word in words])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids, by the offset table."""
        return self.block[ragged(self.offsets[ids], self.lengths[ids])].tobytes()


class PieceCache:
    """What ``encode`` gives for each piece of a text; a worker remembers the pieces it has seen.

    A text whose white space is single spaces and line feeds between words is cut by splitting
    strings, any other by PIECES.  A piece goes by a name: a word after a space by itself, the first
    word of a later line with its line feed, anything else by a space and itself.  ``encode`` gets
    the new pieces of many texts at once.  When full, by number or by weight, the half that was used last
    stays; beyond that a worker holds the pieces of one call.
    """

    def __init__(self, special: Sequence[str], encode: Callable[[list[str]], list], limit: int = PIECE_LIMIT, weight: int = PIECE_BYTES) -> None:
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.special = set(special)
        self.encode = encode
        self.half, self.half_weight = max(1, limit // 2), weight // 2
        self.codes, self.values, self.weight = Codes(), [], 0
        self.older: tuple[dict, list] = {}, []

    def names(self, text: str) -> list[str]:
        """The names of a text's pieces, in order."""
        if self.cut is not None and any(s in text for s in self.special):
            out: list[str] = []
            for part in self.cut.split(text):
                out += [part] if part in self.special else PIECES.findall(part)
            return [" " + x for x in out]
        out = []
        for line in text.split("\n"):
            words = line.split()
            if not words or " ".join(words) != line:
                return [" " + x for x in PIECES.findall(text)]
            words[0] = ("\n" if out else " ") + words[0]
            out += words
        return out

    def of(self, texts: Sequence[str]) -> Iterator[list]:
        """For each text what its pieces give, in order."""
        if len(self.codes) >= self.half or self.weight >= self.half_weight:
            # A call's pieces may weigh more than a half by themselves: then none of them stay.
            self.older = (self.codes, self.values) if self.weight < 2 * self.half_weight else ({}, [])
            self.codes, self.values, self.weight = Codes(), [], 0
        look = self.codes.__getitem__
        coded = [list(map(look, self.names(text))) for text in texts]
        fresh, (known, was) = self.codes.fresh, self.older
        new = [name for name in fresh if name not in known]
        made = iter(self.encode([name[1:] if name[0] == " " else name if name[0] == "\n" else " " + name for name in new]))
        values = [was[known[name]] if name in known else next(made) for name in fresh]
        self.weight += 200 * len(fresh) + 2 * sum(map(len, fresh)) + sum(map(len, values))
        self.values += values
        self.codes.fresh = []
        for codes in coded:
            yield list(map(self.values.__getitem__, codes))


@lru_cache(maxsize=2)
def table(path: str) -> BytePairTable:
    return BytePairTable(path)


@lru_cache(maxsize=2)
def backtracking_cache(path: str) -> PieceCache:
    """One per Python worker: of each piece its ids as 32-bit integers."""
    t = table(path)
    return PieceCache(list(t.special), lambda pieces: list(map(t.encode_piece, pieces)))


def texts_ids(texts: Sequence[bytes | None], path: str) -> Iterator[np.ndarray]:
    """The ids of each text."""
    cache = backtracking_cache(path)
    for at in range(0, len(texts), 256):
        for pieces in cache.of([(x or b"").decode("utf-8") for x in texts[at : at + 256]]):
            yield np.frombuffer(b"".join(pieces), dtype=np.int32)


def encode_decode(texts: list[bytes | None], path: str) -> tuple[list, list, list, list]:
    """Number of ids, SHA-256 of the decimal ids, SHA-256 of the text decoded from the ids, the ids."""
    t = table(path)
    n, of_ids, of_text, all_ids = [], [], [], []
    for ids in texts_ids(texts, path):
        n.append(len(ids))
        all_ids.append(ids)
        digits = b",".join(map(t.decimal.__getitem__, ids.tolist()))
        of_ids.append(hashlib.sha256(digits).hexdigest())
        of_text.append(hashlib.sha256(t.decode(ids).decode("utf-8", errors="replace").encode("utf-8")).hexdigest())
    return n, of_ids, of_text, all_ids


def encode_ids(docs: DataFrame, path: str, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with ``ids`` (array<int>): the exact byte-level BPE of each text; null counts as empty."""

    def compute(texts):
        return (list(texts_ids(texts, path)),)

    return append_columns(docs, text_col, compute, [T.StructField("ids", T.ArrayType(T.IntegerType()))], keep)


def encode_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per row of ``docs``: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if wanted, ``ids``.

    A null or empty text has no ids; both digests are then those of no bytes.  Repeated rows give
    repeated results, other columns are not read, an empty table gives an empty result.
    ``path``: vocabulary file in the tokenizers library's JSON format (byte-level BPE).
    """
    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    return append_columns(docs, text_col, lambda texts: encode_decode(texts, path)[: len(fields)], fields, [id_col])
