"""BPE, records, quality, licences, language and Katz against plain versions."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vacancy_lake.llm import bpe, fertility, katz, language, licences, records
from vacancy_lake.llm.queries import op10_crf, vocabulary

ODD = [
    "", " ", "a", "  a  b\n\n c<|endoftext|> d <|endoftext|><|endoftext|>\t\t x", "it's we'll 'tis  ½²³ ۱۲ 漢字かな 🙂🙂",
    "a" * 3000, "ab" * 2000 + " " * 300 + "x", "\r\n\r\n", "é é\xa0y\x1c", None,
]


def frame(spark, texts, **more):
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit(v) for c, v in more.items()})


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_bpe_equals_the_library_and_comes_back(spark, library):
    df = frame(spark, ODD + ODD[:3], n_tokens="clash", ids="clash")
    got = {r.doc_id: r for r in bpe.encode_digests(df, vocabulary("byte_bpe_50k.json")).collect()}
    assert len(got) == len(ODD) + 3
    for k, text in enumerate(ODD):
        ids = ids_of(library, text)
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    full = bpe.encode_ids(df, vocabulary("byte_bpe_50k.json"), keep=["doc_id"]).collect()
    assert [r.ids for r in sorted(full)][3] == ids_of(library, ODD[3])
    assert bpe.encode_digests(df.filter("false"), vocabulary("byte_bpe_50k.json")).count() == 0


@settings(max_examples=200, deadline=None)
@given(
    st.text(alphabet="abcdethinß漢 '\n.,$12½\xa0", max_size=60)
    | st.lists(st.sampled_from(["the", "it's", "a,b", "Größe", "½x", "\n", "\x1c", "<|endoftext|>", "漢字。", "", "\t"]), max_size=20).map(" ".join)
    | st.lists(st.text(alphabet="thesß ,", max_size=12), max_size=6).map("\n".join)
)
def test_bpe_property(library, text):
    path = vocabulary("byte_bpe_50k.json")
    flat = next(bpe.texts_ids([text.encode()], path))
    assert flat.tolist() == ids_of(library, text)
    own = b"".join(next(records.library_cache(path, "<u2").of([text])))
    assert np.frombuffer(own, "<u2").tolist() == flat.tolist()
    assert bpe.table(path).decode(flat) == text.encode()


def test_records_hold_all_ids_in_order(spark, library):
    df = frame(spark, ODD).withColumn("doc_id", F.when(F.col("doc_id") != 4, 100 - F.col("doc_id")))
    manifest = records.write_records(df, vocabulary("byte_bpe_50k.json"), 2, parts=3)
    got = records.read_records(manifest).collect()
    byid = {None if k == 4 else 100 - k: t for k, t in enumerate(ODD)}
    order = sorted(byid, key=lambda i: (i is not None, i or 0))
    start = 0
    by = {r.doc_id: r for r in got}
    for i in order:
        ids = [*ids_of(library, byid[i]), 2]
        want = (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert tuple(by[i]) == want
        start += len(ids)
    mixed = records.read_shuffled(manifest, 1).sort("place").collect()
    assert {r.doc_id: list(r.ids) for r in mixed} == {i: [*ids_of(library, t), 2] for i, t in byid.items()}
    assert [r.doc_id for r in mixed] != order
    again = frame(spark, ["a b", None, "a b", "c"], file="clash", n_ids="clash", part="clash").withColumn("doc_id", F.lit(7).cast("long"))
    twice = records.read_records(records.write_records(again, vocabulary("byte_bpe_50k.json"), 2, parts=2)).sort("start").collect()
    sizes = sorted(len(ids_of(library, t)) + 1 for t in ("a b", None, "a b", "c"))
    assert sorted(r.n_tokens for r in twice) == sizes and twice[-1].start + twice[-1].n_tokens == sum(sizes)
    wide = records.write_records(again, vocabulary("byte_bpe_50k.json"), 2, parts=2, wide=True)
    assert sorted(r.ids_crc32 for r in records.read_records(wide, wide=True).collect()) == sorted(r.ids_crc32 for r in twice)
    index = records.read_index(wide).collect()
    assert len(index) == 4 and {r.doc_id for r in index} == {7}
    empty = records.write_records(df.filter("false"), vocabulary("byte_bpe_50k.json"), 2)
    assert records.read_records(empty).count() == 0


def test_a_damaged_record_is_refused():
    import io

    data = bytearray(records.frame(7, b"\x01\x00"))
    assert records.parse(records.read_frame(io.BytesIO(bytes(data))), np.dtype("<u2"))[0] == 7
    data[-5] ^= 1
    with pytest.raises(ValueError):
        records.read_frame(io.BytesIO(bytes(data)))


def plain_quality(text):
    text = text or ""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


PATHS = {"piece": vocabulary("piece_bpe_32k.model"), "byte": vocabulary("byte_bpe_multi_50k.tiktoken")}
#: The same two sentences in several scripts.
PROSE = {
    "latin": "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood.",
    "greek": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση, και οφείλουν να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης.",
    "cyrillic": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.",
    "hebrew": "כל בני האדם נולדו בני חורין ושווים בערכם ובזכויותיהם. כולם חוננו בתבונה ובמצפון, לפיכך חובה עליהם לנהוג איש ברעהו ברוח של אחווה.",
    "arabic": "يولد جميع الناس أحرارًا متساوين في الكرامة والحقوق. وقد وهبوا عقلًا وضميرًا وعليهم أن يعامل بعضهم بعضًا بروح الإخاء.",
    "indic": "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए।",
    "thai": "มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิ ต่างมีเหตุผลและมโนธรรม และควรปฏิบัติต่อกันด้วยเจตนารมณ์แห่งภราดรภาพ",
    "cjk": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人人生而自由，在尊严和权利上一律平等。",
    "hangul": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다.",
}


def test_every_script_has_a_band_that_prose_meets():
    assert all(set(b) == {*fertility.SCRIPTS, "none"} for b in fertility.BANDS.values())
    names = [f.name for f in fertility.fields(list(PATHS))]
    rows = fertility.judge([x.encode() for x in PROSE.values()], PATHS, fertility.BANDS)
    for script, row in zip(PROSE, rows, strict=True):
        r = dict(zip(names, row, strict=True))
        assert r["script"] == script and r["reason"] is None, r
    # Letters that the vocabularies know only as bytes: a script of its own, and rare ones of known scripts.
    for odd in ("ܫܠܡܐܫܠܡ", "ᏣᎳᎩᎦᏬᏂ", "𐎀𐎁𐎂𐎃", "𠀀𠀁𠀂𠀃", "ૐ૱૰૱"):
        row = fertility.judge([" ".join(odd[k % len(odd) :] + odd for k in range(70)).encode()], PATHS, fertility.BANDS)[0]
        assert dict(zip(names, row, strict=True))["reason"], odd


def plain_measures(text):
    """Fertility, byte share and entropy with every word given to the libraries anew."""
    import base64

    import sentencepiece
    import tiktoken

    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    sp = sentencepiece.SentencePieceProcessor(model_file=PATHS["piece"])
    with open(PATHS["byte"], "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tt = tiktoken.Encoding("plain", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    single = {i for t, i in ranks.items() if len(t) == 1 and t[0] > 127}
    out = []
    for ids, is_byte in (
        ([i for w in words for i in sp.encode(w)], sp.is_byte),
        ([i for w in words for i in tt.encode_ordinary(" " + w)], single.__contains__),
    ):
        n, counts = len(ids), Counter(ids)
        bits = -sum(c / n * math.log2(c / n) for c in counts.values())
        out += [n, sum(map(len, words)) / n if n else 0.0, sum(map(is_byte, ids)) / n if n else 0.0, bits]
    return out


def test_quality_base_and_bands(spark):
    normal = " ".join(f"word{k}" if k % 3 else "the" for k in range(90))
    texts = ["", None, " \n", "a b c a b c a b c", normal, normal + "\n#$%|<> x\nx\nx", "ab " * 80, "漢字 " * 70, "é è x", *PROSE.values()]
    rows = fertility.quality_rules(frame(spark, texts + texts[:5], kept="clash"), PATHS).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(got) == len(texts) + 5
    for k, text in enumerate(texts):
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_quality(text)
        want = plain_measures(text)
        assert np.allclose(list(r)[-8:], want)
        wrong = None if want[0] else "empty"
        for j, name in enumerate(PATHS):
            n, per, share, bits = want[4 * j : 4 * j + 4]
            low, high, most, least = fertility.BANDS[name][r.script]
            if n and not wrong:
                kind = "fertility" if not low <= per <= high else "byte_fallback" if share > most else "entropy" if bits < min(least * math.log2(n), 4.5) else None
                wrong = kind and f"{name}: {kind}"
        assert r.reason == wrong and r.kept == (not r.base_failed and wrong is None)
    assert got[4].kept and not got[1].kept and got[1].reason == "empty" and got[7].script == "cjk"
    assert fertility.quality_rules(frame(spark, ["x"]).filter("false"), PATHS).count() == 0


def test_repeated_words_of_wide_codes():
    codes = np.array([1 << 22, 5, 7, 9, 1 << 22, 5, 7], dtype=np.int64)
    assert fertility.repeated_words(codes) == 6


def plain_template(markup):
    """The template as a regular expression over words with a space before each."""
    import re

    out = ""
    for item in re.findall(r"\[|\]|\{\d+\}|[^\s\[\]{}]+", markup):
        if item in "[]":
            out += {"[": "(?:", "]": ")?"}[item]
        elif item[0] == "{":
            out += r"(?: \S+){0,%s}" % item[1:-1]
        else:
            out += " (?:" + item.replace("/", "|") + ")"
    return re.compile(out + "(?= )")


def plain_words(text):
    return "".join(c.lower() if c.isascii() and c.isalnum() else c if ord(c) > 127 else " " for c in text or "").split()


def plain_labels(text):
    words = plain_words(text)
    joined = " " + " ".join(words) + " "
    base = [(k, label) for phrase, label in licences.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    labels = {label for _, label in base} | {n for n, m in licences.TEMPLATES.items() if plain_template(m).search(joined)}
    places = [k for k, _ in base]
    return len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels))


def filled(markup, rng):
    """A text that the template accepts."""
    import re

    out, skip = [], 0
    for item in re.findall(r"\[|\]|\{\d+\}|[^\s\[\]{}]+", markup):
        if item == "[":
            skip += bool(skip) or rng.random() < 0.5
        elif item == "]":
            skip = max(0, skip - 1)
        elif not skip:
            out += ["Holder"] * rng.randint(0, 3) if item[0] == "{" else [rng.choice(item.split("/"))]
    return out


def test_licences_equal_brute_force(spark):
    import random

    rng = random.Random(6)
    texts = [
        "Licensed under the Apache License, Version 2.0.", "x CC BY CC BY y", "Released under the terms of the MIT License", None, "", "!!",
        "GNU General Public License gnu general public license", "mitlicense MIT-LICENSE É", "licensed " * 50 + "under the mit license",
    ]
    for name, markup in licences.TEMPLATES.items():
        for _ in range(4):
            own = filled(markup, rng)
            texts.append(" ".join(["Some", *own, "more"]).capitalize())
            bad = list(own)
            bad[rng.randrange(len(bad))] = "altered"
            texts.append(" ".join(bad))
            texts.append(" ".join(own[: rng.randrange(len(own))]))  # its end is missing
            texts.append(" ".join(own[: len(own) // 2] + own))  # begun twice
        assert name in plain_labels(" ".join(own))[-1]
    docs = frame(spark, texts + texts[:2], labels="clash")
    rows = licences.scan_licences(docs).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        assert tuple(r)[1:-1] == plain_labels((texts + texts[:2])[r.doc_id]), texts[r.doc_id]
        accepted = set(r.labels.split(",")) & set(licences.TEMPLATES)
        assert (r.score == 1.0) == bool(accepted) and 0 <= r.score <= 1
    assert licences.scan_licences(docs.filter("false")).count() == 0


def test_a_missing_disclaimer_is_not_accepted():
    mit = filled(licences.TEMPLATES["mit-text"], __import__("random").Random(1))
    assert "mit-text" in licences.scan(" ".join(mit).encode())[5]
    cut = licences.scan(" ".join(mit[: mit.index("express")]).encode())
    changed = licences.scan(" ".join(mit).replace("without warranty", "with warranty").encode())
    assert "mit-text" not in cut[5] + changed[5] and 0.5 < cut[-1] < 1 and 0 < changed[-1] < 1


def test_licence_time_grows_with_the_text():
    import time

    def seconds(text):
        began = time.process_time()
        licences.scan(text)
        return time.process_time() - began

    for part in (b"licensed ", b"mit license ", b"licensed under the gnu general public license ", b"permission to use "):
        licences.scan(part)
        one, two = seconds(part * 25_000), seconds(part * 100_000)
        assert two < 10 * max(one, 0.02), part


def test_automaton_regions():
    a = licences.Automaton("x [y [z]] {2} end/stop")

    def ok(s):
        words = s.encode().split()
        return a.run(words, a.starts(words)) == 1.0

    assert all(map(ok, ["x end", "x y stop", "x y z end", "x q r end", "x y z q r end", "x z end", "x x x x q x y z end"]))
    assert not any(map(ok, ["x y z q r s end", "y end", "x", "x z"]))


def test_language_of_held_out_and_switched_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(docs.filter("doc_id % 4 <> 2"), per_language=100)
    found = language.identify(docs.filter("doc_id % 4 = 2").withColumn("score", F.lit("clash")), model)
    rows = found.filter("length(text) > 40").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    en, de = (docs.filter(F.col("lang") == x).orderBy("doc_id").first().text.split()[:12] for x in ("en", "de"))
    words = language.label_tokens(frame(spark, [" ".join(en + de), None, "12"]), model).collect()
    labels = [r.lang for r in sorted(words, key=lambda r: r.position)]
    half = len(labels) // 2
    assert Counter(labels[: half - 2]).most_common(1)[0][0] == "en" and Counter(labels[half + 2 :]).most_common(1)[0][0] == "de"
    odd = language.identify(frame(spark, [None, "", "12 !", "x" * 5000]), model).collect()
    assert [(r.lang_pred, r.score) for r in odd[:3]] == [("und", 0.0)] * 3 and odd[3].lang_pred != "und"
    numerals = ["½ ²", "①② ③", "Ⅷ Ⅳ", "1½ _ ٣"]
    assert [r.lang_pred for r in language.identify(frame(spark, numerals), model).collect()] == ["und"] * 4
    assert language.words_of("Ⅷ½aß²漢字٣x_y") == ["aß", "漢字", "x", "y"]
    twice = frame(spark, [" ".join(en)] * 3).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    assert {r.lang_pred for r in language.identify(twice, model).collect()} == {"en"} and language.identify(twice, model).count() == 3
    nothing = language.fit(docs.filter("false"))
    assert language.identify(frame(spark, ["abc"]), nothing).first().lang_pred == "und"
    assert language.identify(docs.filter("false"), model).count() == 0


def test_language_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.001"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) > 40").collect()}
    rows = op10_crf(spark, sf).collect()
    held = [r for r in rows if r.held_out and lang.get(r.doc_id)]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert len(held) > 30 and sum(lang[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.95


def test_copies_do_not_crowd_out_the_sample(spark):
    few = [f"zorgu blemi {w} tarka vuno {w}esk" for w in ("aba", "obo", "ulu", "iri", "eke", "ono", "ata", "usu")]
    many = [f"the house {k} of people and their words" for k in range(300)]
    copies = frame(spark, few, lang="zz").crossJoin(spark.range(4000)).drop("id")
    docs = copies.unionByName(frame(spark, many, lang="en"))
    rows = language.training_rows(docs, 10, "text", "lang")
    assert sorted(t for lang, t, _ in rows if lang == "zz") == sorted(few)
    assert len({t for lang, t, _ in rows if lang == "en"}) == 10
    model = language.fit(docs, per_language=10)
    assert model.labels == ["en", "zz"]
    assert language.identify(frame(spark, ["zorgu tarka blemi vuno"]), model).first().lang_pred == "zz"


def test_forward_backward_equals_enumeration():
    from itertools import product

    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 4])
    scores, start, moves = rng.normal(size=(8, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    got, pairs = language.forward_backward(scores, lengths, start, moves, learn=True)
    at, expected, both = 0, [], np.zeros((3, 3))
    for n in lengths:
        p, own = {}, np.zeros((3, 3))
        for path in product(range(3), repeat=n):
            s = start[path[0]] + sum(scores[at + t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
            p[path] = math.exp(s)
        z = sum(p.values())
        expected += [[sum(v for q, v in p.items() if q[t] == y) / z for y in range(3)] for t in range(n)]
        for q, v in p.items():
            for a, b in zip(q, q[1:]):
                own[a, b] += v / z
        both += own
        at += n
    assert np.allclose(got, expected) and np.allclose(pairs, both)


@pytest.mark.parametrize("most", [1, 2, 7, 64])
def test_pieces_change_nothing(monkeypatch, most):
    rng = np.random.default_rng(2)
    lengths = np.array([0, 300, 1, 0, 7, 8, 64, 65, 2, 1000])
    scores, start, moves = 8 * rng.normal(size=(lengths.sum(), 4)), rng.normal(size=4), 3 * rng.normal(size=(4, 4))
    whole, _ = language.forward_backward(scores, lengths, start, moves, learn=True)
    monkeypatch.setattr(language, "PIECE_WORDS", most)
    got, _ = language.forward_backward(scores, lengths, start, moves)
    assert np.allclose(got, whole, rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("n", [[0] * 7, [0, 1, 0, 0, 0, 0, 0], [0, 5, 9, 30, 2, 0, 8], [0, 10**7, 4 * 10**6, 2 * 10**6, 10**6, 7 * 10**5, 5 * 10**5]])
def test_discounts_are_one_estimate_for_all_sizes(n):
    d = katz.discounts(n)
    assert d[0] == 1 and ((d[1:] > 0) & (d[1:] < 1)).all() and (np.diff(d[1:]) > 0).all()


def plain_katz(docs, held):
    words = {i: (t or "").encode().lower().split() + [b""] for i, t in docs.items()}
    uni, bi = Counter(), defaultdict(Counter)
    for i, w in words.items():
        if not held[i]:
            uni.update(w)
            for a, b in zip([b" ", *w], w):
                bi[a][b] += 1
    n, v = sum(uni.values()), len(uni)

    def coc(values):
        c = Counter(values)
        return [0] + [c[r] for r in range(1, katz.K + 2)]

    d1, d2 = katz.discounts(coc(uni.values())), katz.discounts(coc(c for x in bi.values() for c in x.values()))

    def kept(c, d):
        return c - katz.LITTLE if c > katz.K else c * d[c]

    p1 = {w: kept(c, d1) / n for w, c in uni.items()}
    unseen = 1 - sum(p1.values())

    def p(w, h):
        if h not in bi:
            return p1.get(w, unseen)
        c = sum(bi[h].values())
        if w in bi[h]:
            return kept(bi[h][w], d2) / c
        left = 1 - sum(kept(r, d2) for r in bi[h].values()) / c
        return left / (1 - sum(p1[x] for x in bi[h])) * p1.get(w, unseen)

    for h in [b" ", *list(uni)[:20], b"nowhere"]:
        assert abs(sum(p(w, h) for w in uni) + p(b"\x00 new", h) - 1) < 1e-9  # exactly normalised
    out = {}
    for i, w in words.items():
        base = sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w)
        out[i] = (held[i], len(w), sum(x in uni for x in w), n, base, sum(math.log10(p(b, a)) for a, b in zip([b" ", *w], w)))
    return out


@pytest.mark.parametrize("hot", [8, 1000])
def test_katz_equals_a_plain_model(spark, monkeypatch, hot):
    monkeypatch.setattr(katz, "HOT", hot)
    rng = np.random.default_rng(3)
    texts = {k: " ".join(f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 40)) if x < 500) for k in range(120)}
    texts |= {200: None, 201: "", 202: "New words never seen", 203: "w1 w1 w1 w2", 204: "w1 w1 w1 w2"}
    held = {k: k % 7 == 2 or k == 202 for k in texts}
    df = spark.createDataFrame([(k, t, held[k]) for k, t in texts.items()], "doc_id long, text string, h boolean")
    got = {r.doc_id: tuple(r)[1:] for r in katz.katz_scores(df, F.col("h")).collect()}
    for k, want in plain_katz(texts, held).items():
        assert got[k][:4] == want[:4] and np.allclose(got[k][4:], want[4:])
    assert katz.katz_scores(df.filter("false"), F.col("h")).count() == 0
    odd = df.filter("doc_id < 20").unionByName(df.filter("doc_id = 3")).withColumns({"score": F.lit("clash"), "n_known": F.lit("clash")})
    odd = odd.withColumn("doc_id", F.when(F.col("doc_id") != 5, F.col("doc_id")))
    rows = katz.katz_scores(odd, F.lit(False)).collect()
    assert len(rows) == 21 and sum(r.doc_id is None for r in rows) == 1 and len({r.score for r in rows if r.doc_id == 3}) == 1
    assert katz.katz_scores(df, F.lit(True)).count() == len(texts)
