"""Operators on texts against brute force, on small tables with awkward rows."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestrata.llm import bpe, language, minhash, packing, quality, secret_scan, substring_dedup, suffix_dedup

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, symbol string, kept string, spans string, rep int"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(n))


def awkward(seed=0):
    """Copies, near copies, shared passages, runs, empty, null and long texts."""
    rng = random.Random(seed)
    base, passage = words(rng, 60), words(rng, 30)
    near = base.split()
    near[7] = "changed"
    texts = [base, base, " ".join(near), words(rng, 40) + " " + passage, passage, words(rng, 20) + "\n" + passage + "\t" + words(rng, 9), "", None, "x", "a b c"]
    texts += [" ".join(["run"] * 40), " ".join(["run"] * 25) + " end", "ab " * 60, "cd" * 400, "cd" * 300, words(rng, 3000), words(rng, 13), "  \n ", "ünïcödé " * 30, "password=hunter22 token: 'abc' AKIA" + "Q" * 16]
    texts += [words(rng, rng.randint(1, 50)) for _ in range(12)]
    return [(i * 3, t, rng.choice(["aa", "bb", None]), "s", len(t or ""), 1, "y", "z", "w", i) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# --- op1 ---


def brute_secrets(text):
    spans = []
    rules = (("assign", secret_scan.BASE_RULES[0].regex, 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))
    for rank, (kind, rx, group, least) in enumerate(rules):
        flags = re.ASCII if "(?i)" in rx else 0
        spans += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(rx, text or "", flags) if len(m[group]) >= least]
    return [s[2] for s in sorted(spans)]


def test_secrets_match_brute_force(spark):
    texts = ["secret:token:abcdefgh", "É password = 'longenough1' API-KEY=x apikey=ABCDEF", "AKIA1234 AKIA" + "Z9" * 9, "deadbeef" * 3 + "g", "0" * 23, None, "", "PASSWD:\"abcdef\" passwd=abcde"]
    texts += ["ghp_" + "a1" * 18, "-----BEGIN RSA PRIVATE KEY-----", "tok en=nothing", "x" * 5000 + " token=" + "f" * 30]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = pairs(secret_scan.digest(secret_scan.find(df)))
    for i, t in enumerate(texts):
        base = brute_secrets(t)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(got[i]["spans"].split(",")) | {""} and (set(base) or True)
        assert got[i]["n_assign"] == sum(s.startswith("assign") for s in base)
    assert "github:0:40" in got[8]["spans"] and "pem" in got[9]["spans"]


def test_secrets_redact_and_edge_rows(spark, docs, empty):
    found = secret_scan.find(docs)
    assert found.columns == [c for c in docs.columns if c != "spans"] + ["spans"]
    clean = pairs(secret_scan.redact(found))
    assert clean[57]["text"] == "<secret> token: 'abc' <secret>"
    assert clean[21]["text"] is None and len(clean) == docs.count()
    assert secret_scan.find(empty).count() == 0
    twice = docs.select("doc_id", "text").unionAll(docs.select("doc_id", "text"))
    assert secret_scan.find(twice).count() == 2 * docs.count()


def test_trigram_queries():
    assert secret_scan.trigram_query("abcd") == frozenset([frozenset(["abc", "bcd"])])
    assert secret_scan.trigram_query("(?:abc|xyz)+") == frozenset([frozenset(["abc"]), frozenset(["xyz"])])
    assert secret_scan.trigram_query("[a-z]{5}") == secret_scan.ALL
    assert secret_scan.trigram_query("ab(c|d)?e") == secret_scan.trigram_query("abe|abce|abde")
    rng = random.Random(5)
    for rule in secret_scan.RULES:
        query = secret_scan.trigram_query(rule.regex)
        for text in ("password: hunter2222", "api_key=\"zzzzzz\"", "AKIA" + "A" * 16, "xoxb-" + "1" * 12, "sk_live_" + "a" * 16, "gho_" + "x" * 36, words(rng, 50)):
            for m in re.finditer(rule.regex, text):
                held = {m[0].lower()[i : i + 3] for i in range(len(m[0]) - 2)}
                assert any(s <= held for s in query)


# --- op2, op7 ---


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def test_bpe_equals_library(tokenizer):
    enc = bpe.Encoder(bpe.load_spec(VOCABULARY))
    rng = random.Random(1)
    pool = [chr(c) for c in [*range(1, 500), 0x85, 0xA0, 0x2028, 0x3A3, 0x3C2, 0x130, 0xBD, 0x2160, 0x4E00, 0x1F600, 0xFB01, 0x301]]
    texts = ["", "a" * 5000, "<|endoftext|>x<|startoftext|>", "don't stop'LL", "ΑΣ σ", "\x1ca\x1db"]
    texts += ["".join(rng.choices(pool, k=rng.randint(1, 30))) for _ in range(3000)] + [words(rng, 200) for _ in range(20)]
    for t in texts:
        want = tokenizer.encode(t, add_special_tokens=False).ids
        assert enc.encode(t).tolist() == want, t
        assert enc.decode_bytes(enc.encode(t)).decode() == tokenizer.decode(want, skip_special_tokens=False)


def test_bpe_digests(docs, empty, tokenizer):
    got = pairs(bpe.digests(docs, VOCABULARY))
    full = pairs(bpe.encode_decode(docs, VOCABULARY))
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        assert (got[r["doc_id"]]["n_tokens"], full[r["doc_id"]]["ids"]) == (len(ids), ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(full[r["doc_id"]]["decoded"].encode()).hexdigest()
    assert bpe.digests(empty, VOCABULARY).count() == 0


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_is_whole_and_gapless(docs, empty, tokenizer, capacity):
    rows = packing.pack_documents(docs, VOCABULARY, capacity).collect()
    placed, per_doc = {}, {}
    for r in rows:
        placed.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        per_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    total = 0
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        want = []
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want.append((k, at, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))))
        assert sorted(per_doc[r["doc_id"]]) == want
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(placed) <= -(-total // capacity) + 2
    assert packing.pack_documents(empty, VOCABULARY, capacity).count() == 0


def test_plan_packs_any_histogram():
    import numpy as np

    rng = random.Random(2)
    for _ in range(30):
        cap = rng.choice([8, 50, 300])
        h = np.zeros(cap + 1, np.int64)
        for _ in range(rng.randint(0, 40)):
            h[rng.randint(1, cap)] += rng.choice([1, 3, 1000])
        used = np.zeros(cap + 1, np.int64)
        for p, n in packing.plan(h, cap):
            assert sum(p) <= cap and n > 0
            for x in p:
                used[x] += n
        assert (used == h).all()


# --- op3 ---


def brute_windows(rows, window=13):
    first, split = {}, {}
    for i, t in sorted(rows):
        split[i] = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for k in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][k : k + window]), i)
    out = {}
    for i, w in split.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("window", [2, 5, 13])
def test_substring_dedup(docs, empty, window):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = pairs(substring_dedup.digests(docs, window))
    want = brute_windows(rows, window)
    assert {i: tuple(got[i])[1:] for i in got} == want
    cleaned = pairs(substring_dedup.remove(docs, window))
    assert cleaned[0]["text"] == rows_text(rows, 0) and cleaned[3]["text"] == "" and cleaned[3]["kept"] == "z"
    assert substring_dedup.digests(empty, window).count() == 0


def rows_text(rows, i):
    return dict(rows)[i]


def test_substring_dedup_null_and_repeated_ids(spark):
    t = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(None, t), (2, t), (2, t), (5, t)], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_removed"]) for r in substring_dedup.digests(df).collect())
    assert got == [(-1, 0), (2, 0), (2, 0), (5, 20)]


def test_substring_chunks_do_not_depend_on_neighbours():
    from lodestrata.llm.recompression import parse

    rng = random.Random(1)

    def chunks(texts, i):
        w = substring_dedup.Words([t.encode() for t in texts])
        at = w.windows(13)
        name, owner, *_ = w.chunks(parse(w.tokens), at, 13)
        return name[owner == i].tolist()

    for tail in (0, 9, 12, 20, 40):
        for lead in (30, 0):
            for _ in range(40):
                t = " ".join([words(rng, lead), *["0"] * tail]).strip()
                if len(t.split()) >= 13:
                    alone = chunks([t], 0)
                    assert alone == chunks([t, words(rng, 20)], 0) == chunks([words(rng, 9), t, words(rng, 33)], 1) == chunks(["0 0", "", t, "", "0 0"], 2)


def thue_morse(n, a, b):
    """A word of n characters and its complement: a polynomial hash modulo 2**64 cannot tell them apart."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def test_dedup_tells_words_of_equal_polynomials_apart(spark):
    """Neither words of 1024 characters, nor long runs of two words, nor byte strings meet by a weak hash."""
    one, other = thue_morse(1024, "a", "b")
    rng = random.Random(5)
    lead = words(rng, 12)
    line, line2 = (" ".join({"x": "left", "y": "right"}[c] for c in t) for t in thue_morse(2048, "x", "y"))
    rows = [(1, f"{lead} {one}"), (2, f"{lead} {other}"), (3, f"{words(rng, 5)} {line}"), (4, f"{words(rng, 5)} {line2}"), (5, "z" * 9000 + one + "z" * 20), (6, "z" * 300 + other)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.digests(df).collect()}
    assert got == removed_words(rows, 13)
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.digests(df).collect()}
    assert got == removed_bytes(rows, 100)


def removed_words(rows, window):
    seen, out = {}, {}
    for i, text in rows:
        w = text.split()
        for k in range(len(w) - window + 1):
            seen.setdefault(tuple(w[k : k + window]), i)
    for i, text in rows:
        w, gone = text.split(), set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out[i] = len(gone)
    return out


def removed_bytes(rows, length):
    seen, out = set(), {}
    for i, text in rows:
        raw, gone = text.encode(), set()
        for k in range(len(raw) - length + 1):
            if raw[k : k + length] in seen:
                gone |= set(range(k, k + length))
            seen.add(raw[k : k + length])
        out[i] = len(gone)
    return out


def test_substring_dedup_with_equal_last_words(spark):
    """Passes batch the texts in other orders; texts that end in equal words lose all the same."""
    rng = random.Random(2)
    heads = [words(rng, 20) for _ in range(60)]
    rows = [(k * 60 + i, f"{h} {' '.join(['|'] * 20)}") for k in range(3) for i, h in enumerate(heads)]
    rows += [(200 + i, words(rng, 15)) for i in range(60)]
    rng.shuffle(rows)
    got = pairs(substring_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)))
    assert {i: tuple(got[i])[1:] for i in got} == brute_windows(rows)


# --- op4 ---


def brute_bytes(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for k in range(len(raw) - length + 1):
            if raw[k : k + length] in seen:
                gone[k : k + length] = [True] * length
            seen.add(raw[k : k + length])
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("length", [40, 100])
def test_suffix_dedup(docs, empty, length):
    got = pairs(suffix_dedup.digests(docs, length))
    assert {i: tuple(got[i])[1:] for i in got} == brute_bytes([(r["doc_id"], r["text"]) for r in docs.collect()], length)
    assert suffix_dedup.digests(empty).count() == 0
    assert pairs(suffix_dedup.remove(docs))[3]["text"] == ""


@pytest.mark.parametrize("length", [70, 100])
def test_suffix_dedup_splits_hot_anchors(spark, monkeypatch, length):
    """No shard takes more than HOT fragments of an anchor in a very frequent phrase."""
    rng = random.Random(6)
    rows = []
    for phrase in (words(rng, 400)[:n] for n in (45, 88, 130)):
        rows += [f"{words(rng, rng.randint(0, 30))}{phrase}{words(rng, rng.randint(0, 30))}" for _ in range(60)]
        rows += [words(rng, 3) + " " + rng.choice(rows)[rng.randint(0, 60) :] for _ in range(30)]
    rng.shuffle(rows)
    rows = [(i, t) for i, t in enumerate(rows)]
    splits = []
    real = suffix_dedup.split
    monkeypatch.setattr(suffix_dedup, "HOT", 15)
    monkeypatch.setattr(suffix_dedup, "split", lambda hot, n: splits.append((hot.groupBy("anchor").count().agg({"count": "max"}).first()[0], real(hot, n)[0].groupBy("anchor").count().agg({"count": "max"}).first()[0], real(hot, n)[1] is not None)) or real(hot, n))
    got = pairs(suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), length))
    assert {i: tuple(got[i])[1:] for i in got} == brute_bytes(rows, length)
    before, after, strings = splits[0]
    assert before > 50 and after <= 15 and strings


def test_suffix_array_and_spilling(monkeypatch):
    import numpy as np

    from lodestrata.llm import induced_sort

    rng = random.Random(4)
    for memory in (64 << 20, 64):
        monkeypatch.setattr(induced_sort.BucketQueue.__init__, "__defaults__", (memory,))
        for _ in range(150):
            d = bytes(rng.choices(rng.choice([b"a", b"ab", b"abc\x00\xff"]), k=rng.randint(0, 70)))
            order = induced_sort.suffix_array(d)
            assert order.tolist() == sorted(range(len(d)), key=lambda i: d[i:])
            if len(d) > 1:
                for length in (1, 2, 9):
                    raw, whole = np.frombuffer(d, np.uint8), order[order + length <= len(d)]
                    want = [k > 0 and d[whole[k] :][:length] == d[whole[k - 1] :][:length] for k in range(len(whole))]
                    if len(d) >= length:
                        assert induced_sort.as_before(raw, whole, length).tolist() == want
                    near = induced_sort.suffix_array(d, length)
                    assert [d[i:][:length] for i in near] == [d[i:][:length] for i in order]


# --- op6, op8 ---


def labelled(n=240):
    rng = random.Random(9)
    kinds = {"aa": "ab ba bab aba abba", "bb": "xy yx yxy xyx yyx"}
    return [(i, " ".join(rng.choices(kinds[k].split(), k=30)), k) for i, k in ((i, rng.choice(["aa", "bb"])) for i in range(n))]


def test_language_held_out(spark, empty):
    rows = labelled()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df.where("doc_id < 160"))
    got = pairs(language.predict(df, model))
    assert sum(got[i]["lang_pred"] == k for i, _, k in rows if i >= 160) / sum(i >= 160 for i, _, _ in rows) > 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "ab ba"), (5, "ж" * 50)], "doc_id long, text string")
    found = pairs(language.predict(odd, model))
    assert [found[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and found[4]["lang_pred"] == "aa"
    assert found[5]["rejected"] and found[5]["lang_pred"] in ("aa", "bb") and all(0 <= r["score"] <= 1 for r in found.values())
    assert {r["lang_pred"] for r in language.predict(df, language.fit(empty)).collect()} == {"und"}


def test_language_keeps_every_language(spark):
    names = [f"l{i:03d}" for i in range(300)]
    texts = {n: " ".join(random.Random(n).choices(["".join(random.Random(n + str(k)).choices("abcdefghijklmnopqrstuvwxyz", k=6)) for k in range(8)], k=30)) for n in names}
    docs = spark.createDataFrame([(i, texts[n], n) for i, n in enumerate(names)], "doc_id long, text string, lang string")
    model = language.fit(docs, per_language=1, clusters=1)
    assert model.languages == names
    assert {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, model).collect()} == dict(enumerate(names))


def test_quality_orders_grades(spark, empty):
    rng = random.Random(3)
    grade = {0: "junk spam | click", 1: "vile awful nice text", 2: "nice text plain good"}
    rows = [(i, " ".join(rng.choices(grade[i % 3].split(), k=25)) + f" w{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ratings = spark.createDataFrame([(i, i % 3) for i in range(200)] + [(500, None), (None, 1)], "doc_id long, grade int")
    model = quality.fit(docs, ratings)
    assert model.thresholds == sorted(model.thresholds)
    got = pairs(quality.score(docs, model))
    held = [got[i] for i in range(200, 300)]
    assert sum((r["kept"]) == (r["doc_id"] % 3 == 2) for r in held) / len(held) > 0.95
    mean = [sum(r["expected_grade"] for r in held if r["doc_id"] % 3 == g) for g in range(3)]
    assert mean == sorted(mean)
    odd = pairs(quality.score(spark.createDataFrame([(1, None), (2, " \n")], "doc_id long, text string"), model))
    assert not odd[1]["kept"] and not odd[2]["kept"]
    free = quality.score(docs, quality.fit(docs, ratings.limit(0)))
    assert free.where("kept").count() == len(rows)
    assert quality.score(empty, model).count() == 0


# --- op10 ---


def brute_groups(rows, percent, n=5):
    sets, up = {}, {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
        up[i] = i

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((root(a), root(b)))
                    up[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in keys}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(docs, empty, percent):
    got = pairs(minhash.near_duplicates(docs, percent))
    assert {i: tuple(got[i])[1:] for i in got} == brute_groups([(r["doc_id"], r["text"]) for r in docs.collect()], percent)
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicate_chains_and_blocks(spark, monkeypatch):
    """A chain whose ends are unlike one another, with blocks so small that one key fills several."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 4)
    rng = random.Random(8)
    w = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        w = list(w)
        for _ in range(2):
            w[rng.randrange(200)] = f"n{i}{rng.random()}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, rows[5][1]) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = pairs(minhash.near_duplicates(df, 85))
    assert {i: tuple(got[i])[1:] for i in got} == brute_groups(rows, 85)


def test_near_duplicates_of_null_and_repeated_ids(spark):
    t = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(None, t), (None, None), (3, t), (3, t), (4, t)], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in minhash.near_duplicates(df).collect())
    assert got == [(-1, -1, True), (-1, -1, True), (3, 3, True), (3, 3, True), (4, 3, False)]


def test_null_ids_elsewhere(spark):
    df = spark.createDataFrame([(None, "ab token=abcdefgh"), (None, None), (1, "ab")], "doc_id long, text string")
    assert sorted(r["n_tokens"] for r in bpe.digests(df, VOCABULARY).collect())[0] == 0
    assert packing.pack_documents(df, VOCABULARY).count() == 3
    assert sorted(r["n_assign"] for r in secret_scan.digest(secret_scan.find(df)).collect()) == [0, 0, 1]
    assert suffix_dedup.digests(df).count() == 3 and minhash.near_duplicates(df).count() == 3


def test_pigeonhole_keys():
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, (50, minhash.COMPONENTS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(minhash.COMPONENTS, minhash.DISTANCE, replace=False)] += 1
    assert (minhash.chunk_keys(a) == minhash.chunk_keys(b)).any(1).all()


@pytest.mark.parametrize("least", [1, 5])
def test_join_of_hot_keys(spark, monkeypatch, least):
    """Keys meet alike, whether they are broadcast or shuffled."""
    from lodestrata.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", least)
    rows = spark.createDataFrame([(k, i) for k in range(12) for i in range(k)], "k int, i int")
    keyed = rows.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.max("i").alias("m")).where("c > 1")
    got = common.join_counted(rows, keyed, ["k"])
    assert sorted(map(tuple, got.select("k", "i", "m").collect())) == sorted((k, i, k - 1) for k in range(2, 12) for i in range(k))


@pytest.mark.parametrize("hot", [2, 40])
def test_dedup_with_hot_keys(spark, monkeypatch, hot):
    from lodestrata.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 2000)  # several shards in a task
    rng = random.Random(11)
    line, block = words(rng, 40), words(rng, 200)
    rows = [(i, f"{words(rng, rng.randint(0, 20))} {line if i % 3 else block} {words(rng, rng.randint(0, 20))}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.digests(df).collect()} == removed_words(rows, 13)
    assert {r["doc_id"]: r["n_removed"] for r in suffix_dedup.digests(df).collect()} == removed_bytes(rows, 100)
