"""Document fingerprints, the conversations' trie and the dataset manifest against plain versions."""

import hashlib
import math
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from vacancy_lake.llm import imatch, merkle, prefix_trie

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture()
def ranges(spark):
    """Small tables stay in several ranges."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


# --- fingerprints -------------------------------------------------------------------------------


def plain_terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low))


def plain_lexicon(texts, band=imatch.IDF_BAND):
    n, df = len(texts), {}
    for t in texts:
        for w in plain_terms(t):
            df[w] = df.get(w, 0) + 1
    return {w for w, k in df.items() if k >= 2 and band[0] - 1e-12 <= math.log10(n / k) <= band[1] + 1e-12}


def plain_print(text, lexicon):
    kept = sorted(w.encode() for w in plain_terms(text) & lexicon)
    if not kept:
        return xxhash.xxh64(text.encode(), seed=1).hexdigest() + "-" * 8 * 32
    out = xxhash.xxh64(b" ".join(kept)).hexdigest()
    at = 0
    for rate in (512, 128, 32, 8):
        for _ in range(8):
            width = int(math.log2(rate))
            own = [w for w in kept if ((xxhash.xxh128(w, seed=12).intdigest() << 128 | xxhash.xxh128(w, seed=11).intdigest()) >> at) % rate == 0]
            out += xxhash.xxh32(b" ".join(own)).hexdigest() if own else "-" * 8
            at += width
    return out


def plain_likeness(a, b):
    if a == b:
        return 1.0
    rates = [[(a[k : k + 8], b[k : k + 8]) for k in range(i, i + 64, 8)] for i in range(16, 272, 64)]
    held = []
    for pairs in rates:
        if len(held) < 6:
            held += [x == y for x, y in pairs if set(x + y) != {"-"}]
    if len(held) < 6:
        held.append(a[:16] == b[:16])
    return sum(held) / len(held)


def plain_rows(rows):
    """rows: (doc_id, text) in order."""
    texts = [t or "" for _, t in rows]
    lexicon = plain_lexicon(texts)
    out = []
    for k, (doc_id, _) in enumerate(rows):
        own, after = texts[k], texts[(k + 1) % len(rows)]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        f, e, n = (plain_print(x, lexicon) for x in (own, edited, after))
        out.append((doc_id, len(own), sha(edited), f, e, plain_likeness(f, e), plain_likeness(f, n)))
    return out


def some_texts():
    rng = random.Random(3)
    words = [f"w{k}é" if k % 7 == 0 else f"Word{k}" for k in range(60)]
    texts = {k: " ".join(rng.choice(words) for _ in range(rng.randrange(1, 50))) for k in range(5, 60)}
    texts |= {0: None, 1: "", 2: "... !!!", 3: "only once 😀 here", 60: texts[7], 61: texts[7] + " x", 62: "Word1 " * 30_000}
    return texts


@pytest.mark.parametrize("broadcast_terms", [imatch.BROADCAST_TERMS, 0])
def test_fingerprints_equal_brute_force(spark, ranges, broadcast_terms):
    texts = some_texts()
    rows = sorted(texts.items())
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fingerprint": F.lit(1), "part": F.lit("x"), "h": F.lit("y")})
    got = imatch.neighbour_likeness(df, broadcast_terms=broadcast_terms)
    assert got.columns == imatch.RESULT
    want = plain_rows(sorted(texts.items()))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    # Copies have the same fingerprint; a text that lost a part is nearer to its own rest than to a stranger.
    of = {r[0]: r for r in want}
    assert of[60][3] == of[7][3] and of[0][3] == of[1][3] != of[2][3]


def test_fingerprints_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert imatch.neighbour_likeness(spark.createDataFrame([], schema)).count() == 0
    one = imatch.neighbour_likeness(spark.createDataFrame([(4, "abcd")], schema)).first()
    assert (one.n_chars, one.edited_sha256, one.near_next) == (4, sha("abab"), 1.0)
    # Rows without an id come first, rows that share one follow by the hash of their text.
    rows = [(None, "b c d"), (2, "x y"), (2, "z z z z"), (2, "x y"), (1, None)]
    got = imatch.neighbour_likeness(spark.createDataFrame(rows, schema)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hash_of(r[1])))
    assert sorted((r[0] or -1, *r[1:]) for r in map(tuple, got)) == sorted((r[0] or -1, *r[1:]) for r in plain_rows(order))


def hash_of(text):
    """Spark's xxhash64, signed; 42 for null."""
    h = 42 if text is None else xxhash.xxh64(text.encode(), seed=42).intdigest()
    return h - (1 << 64) if h >= 1 << 63 else h


def test_fingerprints_tell_half_texts_from_strangers(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = imatch.neighbour_likeness(docs).collect()
    want = plain_rows([tuple(r) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()])
    assert sorted(tuple(r) for r in got) == want
    long = [r for r in got if r.n_chars > 500]
    near, far = (sum(getattr(r, c) for r in long) / len(long) for c in ("near_edited", "near_next"))
    assert near > 0.2 and near > 3 * far, (near, far)


# --- trie ---------------------------------------------------------------------------------------


def plain_trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for node, cs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaves = [n for n in below if not any(m[:-1] == n for m in members if m)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in cs if built[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        kids = sum(1 for m in members if m and m[:-1] == node)
        out.append((min(cs), len(node), parent, len(cs), kids, len(leaves), saved, sha(ends)))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(8)
    rows = []
    for c in range(60):
        turns = rng.randrange(1, 12)
        rows += [(c, k, rng.choice(["user", None]), rng.choice(["a", "é", None, "long text"]) if k < 3 else f"{c % 7} {k}") for k in range(turns)]
    rows += [(c, k, "user", f"deep {k if k < 55 else (k, c)}") for c in (100, 101, 102, 103) for k in range(60 + c % 3)]
    rows += [(200 + k, 0, "system", "same") for k in range(30)]
    rows += [(300, None, "user", "none"), (300, 1, "user", "tie b"), (300, 1, "user", "tie a"), (300, 1, "user", "tie a"), (-3, 0, "user", "x")]
    return rows + [(None, 0, "user", "nobody's")]


@pytest.mark.parametrize("limit", [256, 3, 0])
def test_trie_equals_brute_force(spark, limit):
    rows = conversations()
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"key": F.lit(1), "depth": F.lit("x"), "path": F.lit("y")})
    got = prefix_trie.conversation_trie(df, limit)
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(rows)


def test_trie_of_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).count() == 0
    # Without the base conversation and with no more turns than are replaced: at the root.
    short = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(short, 0, "user", "x" * 300_000)]
    assert [tuple(r) for r in prefix_trie.conversation_trie(spark.createDataFrame(rows, schema)).collect()] == plain_trie(rows)


def test_long_lists_of_ends_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_PER_ROW", 7)
    df = spark.range(1000).selectExpr("id AS conv_id", "cast(NULL AS binary) AS path", "0 AS depth")
    assert [r.ends_sha256 for r in prefix_trie.end_digests(df).collect()] == [sha(",".join(map(str, range(1000))))]


# --- manifest -----------------------------------------------------------------------------------


def plain_field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(leaves, arity):
    """Root and, for each leaf, its (left, right) siblings by level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for k, i in enumerate(at):
            start = i - i % arity
            paths[k].append(("".join(level[start:i]), "".join(level[i + 1 : start + arity])))
            at[k] = i // arity
        level = [sha("".join(level[i : i + arity])) for i in range(0, len(level), arity)]
    return level[0], paths


def plain_manifest(rows, arity=2):
    def leaf(r):
        return sha("".join(map(plain_field, r)))

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = own, *plain_tree([leaf(r) for r in own], arity)
    root, upper = plain_tree([trees[x][1] for x in langs], arity)
    out = []
    for lang, above in zip(langs, upper, strict=True):
        own, subroot, paths = trees[lang]
        for r, below in zip(own, paths, strict=True):
            path = below + above
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            h = leaf((*r[:3], r[3] + 1, r[4])) if hit else leaf(r)
            for left, right in path:
                h = sha(left + h + right)
            out.append((r[0], leaf(r), subroot, root, sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(out, key=str)


def manifest_rows():
    rng = random.Random(4)
    rows = [(k, f"s{k % 3}", rng.choice(["en", "en", "en", "de", None, "ü"]), k * 2 if k % 4 else None, "text " * (k % 5)) for k in range(90)]
    rows += [(200, None, "lone", 1, None), (None, "s", "en", None, ""), (7, "s", "en", 3, "again"), (7, "s", "en", 3, "again")]
    return rows + [(201, "s", "long", 9, "é" * 200_000)]


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_equals_brute_force(spark, ranges, arity):
    rows = manifest_rows()
    random.Random(6).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumns({"leaf": F.lit(1), "idx": F.lit("x"), "tree": F.lit("y")})
    got = merkle.dataset_manifest(df, arity)
    assert sorted(map(tuple, got.collect()), key=str) == plain_manifest(rows, arity)


def test_manifest_of_odd_tables(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.dataset_manifest(spark.createDataFrame([], schema)).count() == 0
    for rows in ([(1, "s", None, 2, "x")], [(1, "s", "a", 2, "x"), (2, "s", "b", 2, "x")]):
        assert sorted(map(tuple, merkle.dataset_manifest(spark.createDataFrame(rows, schema)).collect()), key=str) == plain_manifest(rows)


def test_places_in_groups(spark, ranges):
    df = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'a' ELSE concat('g', id % 11) END AS g", "1000 - id AS o", "id AS kept")
    got = merkle.numbered(df.unionByName(df.filter("id < 0")), "g", ["o"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.g, []).append(r)
    assert sum(map(len, by.values())) == 1000
    for rows in by.values():
        rows.sort(key=lambda r: r.o)
        assert [r.idx for r in rows] == list(range(len(rows))) and {r.n for r in rows} == {len(rows)}
