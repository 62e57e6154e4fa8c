"""Vocabularies compiled into trie patterns equal one pattern per keyword."""

import random
import re

from pyspark.sql import functions as F

from vacancy_lake import vocabulary as V
from vacancy_lake.functions.text import NO_WORD_AFTER, NO_WORD_BEFORE, keywords_in, phrases_in

ALNUM = ("(?<![a-zA-Z0-9])", "(?![a-zA-Z0-9])")


def one_by_one(spark, texts, words, unicode_words):
    """All keywords of each text by one RLIKE each."""
    before, after = (NO_WORD_BEFORE, NO_WORD_AFTER) if unicode_words else ALNUM
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rules = [(w, before + (" " if unicode_words else r"\s+").join(re.escape(p) for p in w.split(" ")) + after) for w in words]
    rows = df.select("i", *[F.col("t").rlike(p).alias(f"c{k}") for k, (_, p) in enumerate(rules)]).collect()
    return {r.i: sorted(w for k, (w, _) in enumerate(rules) if r[k + 1]) for r in rows}


def compiled(spark, texts, words, unicode_words):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = (phrases_in if unicode_words else keywords_in)(F.col("t"), words)
    return {r.i: r.f for r in df.select("i", found.alias("f")).collect()}


def test_borders_overlaps_and_spaces(spark):
    words = ["r", "redis", "c", "c+", "c++", "c#", "real-time", "near real-time", "sap", "sap bw", "bw", "ai", "ai ml", "ml", "pub/sub",
             "sql", "sql server", "data  lake", " x", "", "đa", "đan", "dữ liệu", "dữ liệu lớn", "lớn", "a_b", "a", "😀", "😀 b", "^$", "(x)", "\\d"]
    texts = [None, "", " ", "r", "redis r", "c++ c+ c# c", "c++c", "near real-time", "near  real-time", "sap\tbw", "sap\n bw sap", "ai  ml",
             "xai ml", "pub/sub,sql server", "data  lake", "data \t lake x", "đan đa", "rõ ràng", "dữ liệu lớn", "dữ liệu lớnx", "a_b a", "a b_",
             "😀 b", "x😀 b", "^$ (x) \\d", "½c", "c²", "é r é", "rr r.r", "ai ml", "sql server sql  server", "r" * 20_000 + " r"]
    for unicode_words in (False, True):
        got = compiled(spark, texts, words, unicode_words)
        assert got.pop(0) == []
        want = one_by_one(spark, ["", *texts[1:]], words, unicode_words)
        assert got == {i: f for i, f in want.items() if i}


def test_random_texts(spark):
    rng = random.Random(5)
    letters = "ab+ /é1_"
    for unicode_words in (False, True):
        words = sorted({"".join(rng.choices(letters, k=rng.randint(1, 4))).strip() for _ in range(120)} - {""})
        words = [w for w in words if "  " not in w or unicode_words]
        texts = ["".join(rng.choices(letters + " \t", k=rng.randint(0, 60))) for _ in range(300)]
        assert compiled(spark, texts, words, unicode_words) == one_by_one(spark, texts, words, unicode_words)


def test_the_preset_lists(spark):
    rng = random.Random(7)
    pool = [*V.SKILLS, *V.DOMAINS, "and", "rõ", "(", ",", "/", "x"]
    texts = [rng.choice(["", " "]).join(rng.choices(pool, k=4)) + " " + " ".join(rng.choices(pool, k=rng.randint(0, 12))) for _ in range(300)]
    for unicode_words, words in ((False, sorted(set(V.SKILLS))), (True, sorted(set(V.DOMAINS)))):
        assert compiled(spark, texts, words, unicode_words) == one_by_one(spark, texts, words, unicode_words)


def test_ten_thousand_phrases_need_no_expression_each(spark):
    rng = random.Random(9)
    names = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 7))) for _ in range(1500)]
    words = sorted({" ".join(rng.choices(names, k=rng.randint(1, 3))) for _ in range(13_500)})
    assert len(words) > 10_000
    texts = [" ".join(rng.choices(names, k=200)) for _ in range(200)]
    want = {}
    for i, t in enumerate(texts):
        tokens = t.split(" ")
        runs = {" ".join(tokens[a : a + n]) for n in (1, 2, 3) for a in range(len(tokens) - n + 1)}
        want[i] = sorted(runs & set(words))
    for unicode_words in (False, True):
        assert compiled(spark, texts, words, unicode_words) == want
    df = spark.createDataFrame([("a",)], "t string").select(phrases_in(F.col("t"), words).alias("f"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") <= 3
