"""Near-duplicates, line dedup, URL rules, decontamination and the pipeline against brute force."""

import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from vacancy_lake.llm import decontaminate, jaccard, line_dedup, queries, simhash, url_filter
from vacancy_lake.llm.components import components

SF = "/root/testdata/sf0.001"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hs = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 4]), 42) for k in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > n)


def plain_groups(fps, distance=4):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_texts():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    texts = {0: None, 1: "", 2: " ", 3: "one", 4: "One", 5: "a b c", 6: "a b c d e"}
    base = [rng.choice(words) for _ in range(120)]
    for k in range(10, 90):
        own = list(base) if k % 2 else [rng.choice(words) for _ in range(60)]
        for _ in range(k % 5 if k % 2 else 0):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts[k] = " ".join(own)
    return texts


@pytest.mark.parametrize("limit", [20_000, 3])
def test_simhash_equals_brute_force(spark, limit):
    texts = near_texts()
    rows = list(texts.items()) + [(10, texts[10]), (None, texts[11])]
    got = simhash.near_duplicates(frame(spark, rows).withColumn("fingerprint", F.lit("clash")), group_limit=limit).collect()
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = plain_groups(fps)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want[11 if r.doc_id is None else r.doc_id]
        assert r.fingerprint == f"{fps[11 if r.doc_id is None else r.doc_id]:016x}"
    kept = simhash.keep_first(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id != 10) == sorted(set(want.values()) - {10})
    assert simhash.near_duplicates(frame(spark, []).filter("false")).count() == 0


def plain_shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))}


def plain_similar(texts, least=0.8):
    ids, sets = sorted(texts), {i: plain_shingles(t) for i, t in texts.items()}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]) - 1e-9:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(("part", "most", "limit"), [(4_000_000, 24, 5_000), (700, 24, 3), (700, 2, 5_000)])
def test_similar_texts_equal_brute_force(spark, part, most, limit):
    rng = random.Random(11)
    texts = near_texts()
    for k in range(100, 180, 2):
        own = [f"w{rng.randrange(300)}" for _ in range(200)]
        texts[k] = " ".join(own)
        for _ in range(rng.randint(1, 5)):
            own[rng.randrange(200)] = "new"
        texts[k + 1] = " ".join(own).upper()
    rows = list(texts.items()) + [(10, texts[10]), (None, texts[11])]
    want = plain_similar(texts)
    found = jaccard.near_duplicates(frame(spark, rows), part_shingles=part, most_parts=most, key_limit=limit)
    got = found.collect()
    assert len(got) == len(rows)
    assert all(r.component_id == want[11 if r.doc_id is None else r.doc_id] for r in got)
    kept = {r.doc_id for r in simhash.keep_first(frame(spark, rows), shingle=5, similarity=0.8).collect()}
    assert kept == set(want.values())
    stage = {r.doc_id for r in corpus_pipeline.first_of_group(spark, frame(spark, rows), SF).collect()}
    assert stage == kept
    # Four of 64 bits miss most of these pairs.
    far = [k for k in range(100, 180, 2) if want[k + 1] == k and (plain_fingerprint(texts[k]) ^ plain_fingerprint(texts[k + 1])).bit_count() > 4]
    assert len(far) > 10
    assert jaccard.near_duplicates(frame(spark, []).filter("false")).count() == 0


def test_pages_of_a_template_form_no_group():
    rng = random.Random(3)
    template = [f"t{k}" for k in range(100)]
    sets = []
    for k in range(1200):
        own = [f"o{rng.randrange(10**6)}" for _ in range(65)]
        sets.append(jaccard.shingles(" ".join(template + own).encode(), 5))
    keys, signatures = zip(*map(jaccard.sketch, sets))
    rows = sorted((int(key), fp, signatures[fp]) for fp, own in enumerate(keys) for key in own)
    batch = pa.RecordBatch.from_pylist([dict(zip(("key", "fp", "signature"), r)) for r in rows])
    met = [b.select(["key", "fp"]) for b in jaccard.crowded(iter([batch.slice(0, 7), batch.slice(7)]))]
    times = Counter(key for key, _, _ in rows)
    assert sum(b.num_rows for b in met) == sum(n for n in times.values() if n > 1) > 800
    # Without signatures over half of the pages would be one group; with them no two are linked.
    for least, most, fewest in ((0.65, 0, 0), (0.0, 1199 * 24, 500)):
        links = list(jaccard.candidate_links(least, 5_000)(iter([batch.slice(0, 99), batch.slice(99)])))
        assert fewest <= sum(b.num_rows for b in links) <= most


def test_pairs_at_the_similarity_are_candidates():
    rng = random.Random(8)
    found = 0
    for _ in range(400):
        n = rng.randint(10, 400)
        shared = rng.sample(range(1 << 62), n)
        own = rng.sample(range(1 << 62), round(n * 0.2 / 0.8))
        cut = rng.randint(0, len(own))
        both = [np.array(sorted(shared + part), np.uint64) for part in (own[:cut], own[cut:])]
        (a, x), (b, y) = map(jaccard.sketch, both)
        close = len(jaccard.signature_links(np.frombuffer(x + y, np.uint8).reshape(2, -1), 0.65))
        found += bool((a == b).any() and close)
    assert found >= 0.98 * 400


def test_links_of_random_fingerprints(spark):
    rng = random.Random(2)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for f in fps[:60]:
        for k in (1, 2, 3, 4, 5):
            fps.append(f ^ sum(1 << b for b in rng.sample(range(64), k)))
    signed = [int(np.uint64(f).astype(np.int64)) for f in set(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.node: r.root for r in components(simhash.fingerprint_links(df)).collect()}
    masked = {f: f & (2**64 - 1) for f in signed}
    want = plain_groups(masked)
    assert all(got.get(f, f) == want[f] for f in signed)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert all(got[k] == 0 for k in range(201)) and got[501] == 500
    assert components(links.filter("false")).count() == 0


def test_lines(spark):
    shared, rare = "Cookie banner", "On four sites only"
    rows = [(k, f"s{k % 6}", f"line {k}\n{shared}\n\n{shared}\n{rare if k % 6 < 4 else 'x' + str(k)}") for k in range(60)]
    rows += [(100, "s1", None), (101, "s2", ""), (102, None, shared), (None, "s3", shared), (103, "s0", shared), (103, "s0", shared)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("n_lines", F.lit("clash"))
    got = line_dedup.remove_boilerplate(df, min_sites=5).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[0].text.count(shared) == 2 and by[0].n_removed == 0
    assert by[7].text == f"line 7\n\n{rare}" and (by[7].n_lines, by[7].n_removed) == (5, 2)
    assert by[100].text is None and by[101].text == "" and (by[100].n_lines, by[101].n_lines) == (0, 1)
    assert by[102].text == by[103].text == by[None].text == "" and by[103].n_removed == 1
    # Far above the threshold the sketch decides, near it the exact count does.
    many = spark.createDataFrame([(k, f"t{k}", "everywhere") for k in range(300)], "doc_id long, source string, text string")
    assert line_dedup.remove_boilerplate(many, min_sites=20).filter("n_removed = 1").count() == 299
    assert line_dedup.remove_boilerplate(df.filter("false")).count() == 0


@pytest.mark.parametrize("name", ["op6_url_rules", "op7_line_spread"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, ref = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(ref.columns)
    key = lambda r: [str(v) for v in r]
    got = sorted([tuple(r[c] for c in columns) for r in df.collect()], key=key)
    at = [ref.columns.index(c) for c in columns]
    assert got == sorted([tuple(r[k] for k in at) for r in ref.fetchall()], key=key)


def test_url_edges(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1?x", "https://example.org", "http://notexample.org/es/",
        "http://x.org/EN/1", "http://example.org/en/12", "http://a.com/de", "http://a.com/de/", "ftp://b.com/fr/?casino", "http://q.net/?utm_source=feed",
        "http://q.net/utm_source=feeder", "http://q.net/?page=3&ref=x", "http://org/", "http://q.net/casino",
    ]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)] + [(None, urls[4])], "page_id long, url string")
    got = {r.page_id: r for r in url_filter.filter_urls(df.withColumn("host", F.lit("clash")), url_filter.RULES).collect()}
    rules = {k: (r.host, r.path, r.rule, r.verdict) for k, r in got.items()}
    assert len(got) == len(urls) + 1
    assert rules[0] == rules[1] == rules[2] == rules[3] == ("", "", None, "allow")
    assert rules[4] == ("a.example.org", "/es/1", "example.org/es/", "block") == rules[None]
    assert rules[5] == ("example.org", "", None, "allow") and rules[6][2] == "org/"
    assert rules[7][2:] == ("org/", "allow") and rules[8][2:] == ("example.org/en/1", "block")
    assert rules[9][2] is None and rules[10][2:] == ("com/de/", "block") and rules[11][2:] == ("com/fr/", "allow")
    assert got[12].pattern == "^utm_source=feed^" and rules[12][3] == "block" and rules[13][3] == "allow"
    assert rules[14][3] == "block" and rules[15][2] == "org/" and got[16].pattern == "^casino^"
    assert url_filter.filter_urls(df.filter("false"), url_filter.RULES).count() == 0


def plain_verdict(url, patterns):
    """The winning pattern, every one tried: characters are matched one by one."""

    def here(p, u, k):
        if not p:
            return True
        if p == "|":
            return k == len(u)
        if p[0] == "*":
            return any(here(p[1:], u, j) for j in range(k, len(u) + 1))
        if p[0] == "^":
            if k in (0, len(u)) and here(p[1:], u, k):
                return True
            return k < len(u) and not ("a" <= u[k] <= "z" or "0" <= u[k] <= "9") and here(p[1:], u, k + 1)
        return k < len(u) and u[k] == p[0] and here(p[1:], u, k + 1)

    u, found = url.lower(), []
    for p in patterns:
        body = p.removeprefix("@@")
        if body.startswith("||"):
            at = u.find("://") + 3
            host = u[at:].replace("?", "/").replace("#", "/").split("/")[0]
            starts = [at, *[at + k + 1 for k, c in enumerate(host) if c == "."]] if at > 2 else []
            hit = any(here(body[2:], u, k) for k in starts)
        elif body.startswith("|"):
            hit = here(body[1:], u, 0)
        else:
            hit = any(here(body, u, k) for k in range(len(u) + 1))
        if hit:
            found.append((p.startswith("@@"), len(p), p))
    return max(found)[2] if found else None


def test_url_patterns_equal_brute_force(spark, monkeypatch):
    rng = random.Random(12)
    odd = ["|http://a*.zip|", "||ads.*/x^", "^b^*^c^", "@@||wiki.*/casino^", "|ftp://"]
    patterns = url_filter.PATTERNS + odd
    bits = ["casino", "ads.", "a", "wiki.", "/", "?", "=", "&", ".zip", "x", "login", "/wiki/", "sid=", "b", "c", "-", ".", "ref=x", "page=", "Casino"]
    urls = [rng.choice(["http://", "ftp://", "https://", ""]) + "".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = [url_filter.pattern_rule(p) for p in patterns]
    want = {k: plain_verdict(u, patterns) for k, u in enumerate(urls)}
    assert len(set(want.values())) > 8
    for limit in (10_000, 10):  # the index broadcast, and not
        monkeypatch.setattr(url_filter, "BROADCAST_RULES", limit)
        rows = url_filter.filter_urls(df, rules).collect()
        assert {r.page_id: r.pattern for r in rows} == want
        assert all((r.verdict == "block") == bool(r.pattern and not r.pattern.startswith("@@")) for r in rows)


def test_more_rules_than_are_broadcast(spark):
    rules = [url_filter.pattern_rule(f"^tok{k}^") for k in range(10_050)]
    df = spark.createDataFrame([(k, f"http://h.net/tok{k * 41}/x") for k in range(300)], "page_id long, url string")
    got = {r.page_id: r.pattern for r in url_filter.filter_urls(df, rules).collect()}
    assert got == {k: f"^tok{k * 41}^" if k * 41 < 10_050 else None for k in range(300)}
    with pytest.raises(ValueError):
        url_filter.pattern_rule("*a*")


def plain_leaks(texts, items, rate=0.2):
    found = {}
    for d, text in texts.items():
        words = decontaminate.words_of((text or "").encode())
        for i, item in items.items():
            own = decontaminate.words_of((item or "").encode())
            limit = int(len(own) * rate + 1e-9)
            if not own:
                continue
            row = list(range(len(own) + 1))
            best = row[-1]
            for w in words:
                new = [0]
                for k, x in enumerate(own, 1):
                    new.append(min(row[k] + 1, new[-1] + 1, row[k - 1] + (w != x)))
                row = new
                best = min(best, row[-1])
            if best <= limit:
                found[d, i] = best
    return found


def test_leaks_reach_the_recall_and_are_exact(spark):
    rng = random.Random(8)
    common, rare = [f"c{k}" for k in range(40)], [f"r{k}" for k in range(3000)]

    def words(n):
        return [rng.choice(common if rng.random() < 0.5 else rare) for _ in range(n)]

    items = {k: " ".join(words(rng.randint(8, 60))) for k in range(40)} | {90: None, 91: "", 92: "!!", 93: "solo"}
    texts = {500: None, 501: "", 502: "Solo, solo!", 503: items[3].upper() + " " + items[3]}
    for k in range(160):
        own = words(rng.randint(0, 200))
        if k % 2:
            item = items[rng.randrange(40)].split()
            for _ in range(rng.randint(0, len(item) // 5)):
                at, kind = rng.randrange(len(item)), rng.randrange(3)
                item[at : at + (kind < 2)] = [] if kind == 0 and len(item) > 2 else [rng.choice(rare)]
            at = rng.randint(0, len(own))
            own[at:at] = item
        texts[k] = " ".join(own)
    want = plain_leaks(texts, items)
    rows = list(texts.items()) + [(503, texts[503]), (None, texts[503])]
    docs = frame(spark, rows).withColumn("item_id", F.lit("clash"))
    table = frame(spark, list(items.items()), "item_id long, text string")
    rows = decontaminate.find_leaks(docs, table).collect()
    assert sum(r.doc_id == 503 for r in rows) == 2 * sum(r.doc_id is None for r in rows) > 0
    got = {(r.doc_id, r.item_id): r.distance for r in rows if r.doc_id is not None}
    assert set(got) <= set(want) and len(got) >= 0.95 * len(want) and len(want) > 60
    assert all(got[p] == want[p] for p in got)
    clean = {r.doc_id for r in decontaminate.drop_leaks(docs, table).collect()}
    assert clean == set(texts) - {d for d, _ in got}  # the null id went, too
    assert decontaminate.find_leaks(docs, table.filter("false")).count() == 0
    assert decontaminate.find_leaks(docs.filter("false"), table).count() == 0


def test_every_item_reaches_the_recall_or_has_exact_candidates():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(3, 60))).encode()) for k in range(60)]
    items += [(90, b"a b " * 20), (91, b"a " * 30), (92, b"x"), (93, b"a a b")]
    index = decontaminate.build_index(items, 0.2, 0.98, 9)
    assert all((c.recall >= 0.98).all() for c in index.classes)
    # Simulated anew: of each item edits at its limit, in a text of other words.
    numbers, found, tried = np.random.default_rng(77), {}, {}
    name = {v: k for k, v in index.vocabulary.items()} | {0: b"zzz"}
    for k, own in enumerate(index.codes):
        for _ in range(20):
            passage = b" ".join(name[c] for c in decontaminate.edited(own, int(index.limits[k]), numbers).tolist())
            text = b"q " * 30 + passage + b" q" * 30
            tried[k] = tried.get(k, 0) + 1
            found[k] = found.get(k, 0) + any(x == k for _, x, *_ in decontaminate.search(index, [text]))
    assert min(found[k] / tried[k] for k in tried) >= 0.85 and sum(found.values()) >= 0.98 * sum(tried.values())


def test_exact_candidates_lose_nothing(monkeypatch):
    monkeypatch.setattr(decontaminate, "REPETITIONS", 2)
    rng = random.Random(4)
    words = [f"w{k}" for k in range(30)]
    items = {k: " ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for k in range(30)}
    index = decontaminate.build_index([(k, t.encode()) for k, t in items.items()], 0.2, 1.1, 9)
    assert all(c.pieces for c in index.classes)
    texts = {}
    for k in range(60):
        own = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        item = items[rng.randrange(30)].split()
        for _ in range(rng.randint(0, len(item) // 5)):
            item[rng.randrange(len(item))] = rng.choice(words)
        at = rng.randint(0, len(own))
        texts[k] = " ".join(own[:at] + item + own[at:])
    got = {(d, i): far for d, i, far, _ in decontaminate.search(index, [t.encode() for t in texts.values()])}
    assert got == plain_leaks(texts, items)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 12)
    items = frame(spark, [(k, " ".join(f"i{k}w{j}" for j in range(10))) for k in range(4)], "item_id long, text string")
    docs = frame(spark, [(9, "x " + " ".join(f"i2w{j}" for j in range(10)) + " y")])
    got = decontaminate.find_leaks(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.distance, r.end_word) for r in got] == [(9, 2, 0, 11)]
    assert decontaminate.find_leaks(docs.filter("false"), items).count() == 0
    assert decontaminate.drop_leaks(docs, items).count() == 0


def test_pipeline(spark, tmp_path):
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    first = raw.orderBy("doc_id").first()
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()
    odd = [(9000, None, "en", "src1", 0), (9001, "12 34", "en", "src1", 5), (9002, first.text, first.lang, "src2", 1), (9003, "Zz " + item.text, "es", None, 2), (None, "Der und die das ist nicht.", "de", "src1", 3)]
    docs = raw.unionByName(spark.createDataFrame(odd, raw.schema)).withColumn("lang_pred", F.lit("clash"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in now.select("doc_id").collect()}
        out = stage(spark, now, str(tmp_path))
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        now = spark.read.parquet(path)
        after = {r.doc_id for r in now.select("doc_id").collect()}
        assert after <= before
        if name != "bpe":
            assert now.columns == docs.columns
        if name == "language":
            assert not after & {9000, 9001} and len(before - after) <= 4
        if name == "near_dedup":
            assert 9002 not in after and first.doc_id in after
            assert simhash.keep_first(now).count() == now.count()
        if name == "decontamination":
            leaks = plain_leaks({r.doc_id: r.text for r in now.limit(30).collect()}, {item.item_id: item.text})
            assert 9003 not in after and not leaks
    assert now.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and now.count() > 100
    assert now.filter("n_tokens <> size(ids)").count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.filter("false"), str(tmp_path)).count() == 0


def test_near_fingerprints_are_candidates(spark):
    """Texts whose SimHash fingerprints are linked meet, without a common MinHash key, too."""
    prints = [0b1111, 0b1001, -1, 0xFFFFF << 40, 0b1111 | 0b1111 << 20, 0b1111]
    rows = [(k, [k + 100], p) for k, p in enumerate(prints)] + [(9, [], 0b1111)]
    texts = spark.createDataFrame(rows, "fp long, keys array<long>, simhash long")
    found = {r.fp: r for r in jaccard.with_near_key(texts).collect()}
    near = [found[k].near for k in range(len(prints))]
    assert near[0] == near[1] == near[4] == near[5] and len(set(near)) == 3
    assert all(found[k]["keys"] == [k + 100, near[k]] for k in range(len(prints))) and found[9]["keys"] == []
    sets = [np.arange(10, dtype=np.uint64), np.arange(9, dtype=np.uint64)]
    assert jaccard.group_links(sets, np.array([[1, near[0]], [2, near[1]]]), 0.8) == [(0, 1)]
    assert jaccard.group_links(sets, np.array([[1, near[0]], [2, near[2]]]), 0.8) == []
