"""Fill-in-the-middle and importance resampling against plain second versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrata.llm import fill_middle, importance

SF = "/root/testdata/sf0.001"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- rank and select --------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2000), st.floats(0, 1), st.integers(0, 99))
def test_bit_vector(size, density, seed):
    bits = np.random.default_rng(seed).random(size) < density
    v = fill_middle.BitVector(bits)
    assert v.rank(np.arange(size + 1)).tolist() == [0, *np.cumsum(bits).tolist()]
    assert v.select(np.arange(1, bits.sum() + 1)).tolist() == np.flatnonzero(bits).tolist()


# --- fill in the middle -------------------------------------------------------------------------------


def rearranged(key, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = sha(f"7:{'' if key is None else key}")
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:z]), "".join(units[z:])
    form = "spm" if h4 % 100 < spm else "psm"
    return n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


ODD = [
    None, "", "\n", "\n\n\n", "one line", "a\nb", "a\nb\n", "é\nü\n𝔘𝔫𝔦\n\n終", "ends in <\nP>\n<", "<P\n<S\n<M", "a <P> mark\nb", "<S>", "x\n<M>\ny", "\r\n\r\n \n", "\x00\n\x01",
    "long\n" * 5000, "w" * 3_000_000, "zwölf\n" * 700_000, "same\ntext\n", "same\ntext\n",
]


def test_fill_middle(spark, monkeypatch):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab\n\né<>PSM") for _ in range(rng.randrange(80))) for _ in range(300)]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, "a repeated\nid\n", "y", 2), (3, "a repeated\nid\n", "y", 2), (None, "no\nid\nat\nall", "z", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, n int")  # names of the result as extra columns
    out = fill_middle.transform(df)
    got = out.withColumn("back", fill_middle.restore(out["output"], out["form"])).collect()
    assert sorted(map(str, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got))) == sorted(map(str, ((k, *rearranged(k, t), t or "") for k, t, _, _ in rows)))
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    digests = {tuple(r) for r in fill_middle.digests(df).collect()}
    assert digests == {(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, sha(r.output), sha(r.back)) for r in got}


def test_fill_middle_rates_and_empty_table(spark):
    rows = [(i, f"line {i}\n" * (i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in fill_middle.transform(df, rate=30, spm=10).collect()}
    assert got == {k: rearranged(k, t, 30, 10) for k, t in rows}
    assert fill_middle.digests(df.limit(0)).collect() == []


# --- importance resampling -----------------------------------------------------------------------------


def resampled(docs, target, percent=10, least=20, buckets=10_000, longest=1, seed="2024"):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    runs = lambda w: [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for b in runs(words(x)):
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for key, x in docs:
        f = runs(words(x))
        h = int(sha(f"{seed}:{'' if key is None else key}")[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(x)) >= least])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for n, r in enumerate(able[: len(able) * percent // 100], 1):
        r[4] = n
    return sorted((tuple(r[:5]) for r in rows), key=str)


def texts_of(rng, n):
    vocabulary = ["alpha", "Beta", "GAMMA", "élan", "x1", "naïve—so", "0", "ß", "Ä", *(f"w{i}" for i in range(200))]
    return ["".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "\x00", "_", " "]) for _ in range(rng.choice((0, 3, 19, 20, 21, 60)))) for _ in range(n)]


def test_resample(spark):
    rng = random.Random(8)
    docs = [*enumerate(texts_of(rng, 400)), (1000, None), (1001, ""), (1002, "word " * 200_000), (-5, "beta " * 30), (1 << 62, "beta " * 30), (-(1 << 63), "gamma " * 25), (None, "beta " * 30)]
    target = [t for t in texts_of(rng, 40) if t] + [None, "word word"]
    d = spark.createDataFrame([(k, t, "n", 5) for k, t in docs], "doc_id long, text string, rank string, score int")
    b = spark.createDataFrame([(t,) for t in target], "text string")
    assert sorted((tuple(r) for r in importance.resample(d, b).collect()), key=str) == resampled(docs, target)
    got = importance.resample(d, b, percent=37, least_words=3, buckets=97, longest=3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == resampled(docs, target, 37, 3, 97, 3)


def test_resample_repeated_rows_are_drawn_in_exact_number(spark):
    docs = [(7, "beta " * 30)] * 300 + [(8, "alpha " * 30)] * 100
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = importance.resample(d, d, percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 201)) and len(got) == 400
    want = resampled(docs, [t for _, t in docs], 50)
    assert sorted((r.doc_id, r.score, r["rank"] is not None) for r in got) == sorted((k, s, n is not None) for k, _, _, s, n in want)


def test_resample_empty_tables(spark):
    d = spark.createDataFrame([(1, "beta " * 30), (2, None)], "doc_id long, text string")
    none = d.limit(0)
    assert importance.resample(none, d).collect() == []
    assert sorted(map(str, importance.resample(d, none.select("text"), percent=100).collect())) == sorted(
        f"Row(doc_id={k}, n_features={n}, weight={w}, score={s}, rank={r})" for k, n, w, s, r in resampled([(1, "beta " * 30), (2, None)], [], 100)
    )


def test_radix_selection_over_wide_keys(spark):
    rng = random.Random(2)
    some = [rng.choice((-1, 1)) * rng.getrandbits(rng.choice((3, 20, 62))) for _ in range(60)]
    rows = sorted((rng.choice(some), rng.choice(some), i) for i in range(500))
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(4)
    for k in (1, 2, 77, 250, 499, 500):
        key = importance.kth_key(df, ["a", "b", "c"], k)
        assert [r for r in rows if r <= key] == rows[:k]


def test_queries_over_whole_table(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    from lodestrata.llm.queries import ORACLES, QUERIES

    for name in ("op11_fill_middle", "op13_importance"):
        df = QUERIES[name](spark, SF)
        want = con.sql(ORACLES[name])
        assert sorted(str([r[c] for c in want.columns]) for r in df.collect()) == sorted(str(list(r)) for r in want.fetchall())
