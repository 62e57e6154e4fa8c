"""Column expressions for text that the rest builds on."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A border of a Unicode word, written out: ``\\b`` changes its meaning between Java versions.
NO_WORD_BEFORE, NO_WORD_AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
NO_ALNUM_BEFORE, NO_ALNUM_AFTER = "(?<![a-zA-Z0-9])", "(?![a-zA-Z0-9])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that it uses many times: as a lambda's variable it is computed once, where
    the optimizer would put a column's expression in every place that names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Unicode white space, what ``(?U)\\s`` stands for.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.trim(c, F.lit(WHITE))


def is_blank(c: Column) -> Column:
    """Null, empty or white space only."""
    return c.isNull() | (strip(c) == "")


def given(c: Column) -> Column:
    """True if not null and not empty."""
    return F.coalesce(F.length(c) > 0, F.lit(False))


def collapse_spaces(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def word_borders(pattern: str) -> str:
    """``\\b`` at the start and end of words, as explicit look-arounds."""
    return re.sub(r"\\b(?=[\w(])", lambda _: NO_WORD_BEFORE, pattern).replace(r"\b", NO_WORD_AFTER)


def _needed(pattern: str) -> list[str] | None:
    """For each alternative a text of which no match is without; None if the pattern has more than letters,
    digits, ``\\b``, ``\\s*`` and plain signs."""
    parts = [re.split(r"\\b|\\s\*", each) for each in pattern.split("|")]
    longest = [max(each, key=len) for each in parts]
    plain = all(re.fullmatch(r"[\w &]*", p) for each in parts for p in each)
    return longest if plain and all(longest) else None


def first_match(c: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Value of the first pattern found in ``c``, else null.  A pattern runs only on texts that hold what it needs."""

    def found(pattern: str) -> Column:
        needed, match = _needed(pattern), c.rlike(word_borders(pattern))
        return reduce(Column.__or__, [c.contains(n) for n in needed]) & match if needed else match

    return F.coalesce(*[F.when(found(p), F.lit(v)) for p, v in rules])


def join_given(*columns: Column) -> Column:
    """All non-empty texts, joined by a space, in lower case."""
    return F.lower(F.concat_ws(" ", *[F.when(given(c), c) for c in columns]))


def _ascii_alnum(c: str) -> bool:
    return c.isascii() and c.isalnum()


def _word_character(c: str) -> bool:
    return c == "_" or unicodedata.category(c)[0] in "LN"


#: A place of a trie with more branches is asked in groups of so many.
GROUPED = 6


def _trie_pattern(words: Iterable[str], border: str, spaces: str | None) -> str:
    """Pattern of all ``words`` as one character trie: a text position is compared with shared beginnings
    once, however many words begin so.  ``border`` follows each word; ``spaces`` stands for a space."""
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[None] = {}

    def literal(c: str) -> str:
        return spaces if spaces and c == " " else re.escape(c)

    def grouped(each: list[tuple[str, str]]) -> list[str]:
        """Many branches are asked by groups of first characters: one look at a class instead of a try of each."""
        plain = [(c, p) for c, p in each if literal(c) != spaces]
        if len(plain) <= GROUPED:
            return [p for _, p in each]
        groups = [plain[k : k + GROUPED] for k in range(0, len(plain), GROUPED)]
        asked = [f"(?=[{''.join(re.escape(c) for c, _ in g)}])(?:{'|'.join(p for _, p in g)})" for g in groups]
        return [*asked, *[p for c, p in each if literal(c) == spaces]]

    def branches(node: dict) -> str:
        each = []
        for c in sorted(c for c in node if c is not None):
            child, head = node[c], literal(c)
            while len(child) == 1 and None not in child:
                (inner, child), = child.items()
                head += literal(inner)
            each.append((c, head + branches(child)))
        each = [*grouped(each), *([border] if None in node else [])]
        return each[0] if len(each) == 1 else "(?:" + "|".join(each) + ")"

    return branches(root)


def _layers(words: Iterable[str], inside: Callable[[str], bool]) -> list[list[str]]:
    """``words`` dealt so that of one layer no two can end properly at the same start of a text: one that
    begins with another, followed by no character that is ``inside`` a word, is one layer deeper."""
    known, depth = set(words), {}
    for w in sorted(known, key=len):
        starts = [w[:k] for k in range(1, len(w)) if not inside(w[k])]
        depth[w] = max((depth[p] + 1 for p in starts if p in known), default=0)
    return [[w for w in sorted(known) if depth[w] == d] for d in range(max(depth.values(), default=-1) + 1)]


def _beginnings(layer: list[str], first: list[str], spaces: str | None) -> list[str] | None:
    """What a text must hold one of, as it stands, to hold a word of ``layer``; None if that is too much to ask."""
    own = {min((v for v in first if w.startswith(v)), key=len) for w in layer} if len(layer) <= GROUPED else set()
    return sorted({v.split(" ")[0] if spaces else v for v in own}) or None


def _words_found(text: Column, vocabulary: Iterable[str], before: str, after: str, inside: Callable[[str], bool], spaces: str | None) -> Column:
    """Sorted distinct words of ``vocabulary`` that stand in ``text`` between the borders.

    The vocabulary is compiled into one pattern per layer (as many as words begin with each other, two or
    three as a rule), so the plan holds no expression per word.  A look-ahead takes the word at every
    position, overlapping ones too.
    """
    words = sorted(set(vocabulary))
    none = F.array().cast("array<string>")
    if not words:
        return none
    # Words whose own white space is not single inner spaces run an expression each.
    odd = [w for w in words if not w or (spaces and " ".join(re.split(r"[ \t\n\x0b\f\r]+", w.strip(" \t\n\x0b\f\r"))) != w)]
    layers = _layers([w for w in words if w not in set(odd)], inside)

    def found(text: Column) -> Column:
        parts = []
        for layer in layers:
            part = F.regexp_extract_all(text, F.lit(f"{before}(?=({_trie_pattern(layer, after, spaces)}))"), F.lit(1))
            # A word of a deeper layer begins with one of the first: few texts hold any of a short layer's beginnings.
            needed = _beginnings(layer, layers[0], spaces) if parts else None
            parts.append(F.when(reduce(Column.__or__, [text.contains(v) for v in needed]), part).otherwise(none) if needed else part)
        if spaces and any(" " in w for layer in layers for w in layer):
            parts = [F.transform(F.array_distinct(p), lambda w: F.regexp_replace(w, r"\s+", " ")) for p in parts]
        if odd:
            each = [before + (r"\s+" if spaces else " ").join(re.escape(p) for p in w.split(" ")) + after for w in odd]
            parts.append(F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(w)) for w, p in zip(odd, each)])))
        return F.array_sort(F.array_distinct(F.concat(*parts)))

    return F.coalesce(let(text, found), none)


def keywords_in(text: Column, vocabulary: Iterable[str]) -> Column:
    """Sorted distinct keywords of ``vocabulary`` that stand in the lower-cased ``text`` between
    characters other than ASCII letters and digits; their spaces stand for any white space.  Null: none."""
    return _words_found(text, vocabulary, NO_ALNUM_BEFORE, NO_ALNUM_AFTER, _ascii_alnum, r"\s+")


def phrases_in(text: Column, vocabulary: Iterable[str]) -> Column:
    """Sorted distinct keywords that stand in the lower-cased ``text`` as whole Unicode words.  Null: none."""
    return _words_found(text, vocabulary, NO_WORD_BEFORE, NO_WORD_AFTER, _word_character, None)


def first_contained(text: Column, rules: Iterable[tuple[str, Column]]) -> Column:
    """Value of the first literal that ``text`` contains, else null."""
    return F.coalesce(*[F.when(text.contains(k), v) for k, v in rules])
