"""Fitted operators: toxicity, language and quality by hand, and repairs of the others."""

import math
import random

import numpy as np
import pytest

from lodestrata.llm import common, language, quality, secret_scan, substring_dedup, suffix_dedup, toxicity, vectors
from lodestrata.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


# --- toxicity -------------------------------------------------------------------------------------------


def ballots(rng, n, share, accuracy, copies):
    """Votes of independent voters of known accuracy, the first of which ``copies`` others repeat."""
    y = rng.random(n) < share
    cols = []
    for a in accuracy:
        right = rng.random(n) < a
        vote = np.where(right == y, 1, -1)
        vote[rng.random(n) < 0.2] = 0
        cols.append(vote)
    cols += [np.where(rng.random(n) < 0.98, cols[0], 0) for _ in range(copies)]
    return y, np.stack(cols, 1)


def test_label_model_finds_accuracies_and_correlations_without_labels():
    rng = np.random.default_rng(5)
    accuracy = [0.75, 0.9, 0.85, 0.8, 0.95]
    y, v = ballots(rng, 6000, 0.3, accuracy, 4)
    model = toxicity.fit_labels(v, 0.3)
    assert np.abs(model.accuracies()[:5] - accuracy).max() < 0.06
    assert model.correlations[0, 5:].min() > 0.8 and np.abs(model.correlations[1, 2:5]).max() < 0.15
    assert model.weights[0] < 0.3 and model.weights[1] > 0.6
    found = model.posterior(v) > 0.5
    alone = (v.sum(1) > 0) == y  # the majority listens to the copies
    assert (found == y).mean() > 0.94 > alone.mean()


def test_posterior_by_hand():
    tables = np.array([[[0.7, 0.2, 0.1], [0.1, 0.2, 0.7]], [[0.5, 0.3, 0.2], [0.2, 0.3, 0.5]]])
    model = toxicity.LabelModel(0.2, tables, np.eye(2), np.array([1.0, 0.5]))
    z = math.log(0.2 / 0.8) + math.log(0.7 / 0.1) + 0.5 * math.log(0.2 / 0.5)
    assert model.posterior(np.array([[1, -1]]))[0] == pytest.approx(1 / (1 + math.exp(-z)))


def planted(rng, n):
    clean = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        words = rng.choices(clean, k=rng.randint(8, 120))
        bad = rng.random() < 0.25
        if bad:
            for _ in range(2 + len(words) // 30):
                words.insert(rng.randrange(len(words)), rng.choice(["zonk", "quirl" + rng.choice("abcdef") * 3, "Wöxel"]))
        rows.append((i, " ".join(words) + rng.choice([".", "!", "\nend"]), int(bad)))
    return rows


def test_toxicity(spark):
    rows = planted(random.Random(1), 500)
    docs = spark.createDataFrame([(i, t, "x", 9) for i, t, _ in rows], "doc_id long, text string, score string, predicted int")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows if i % 3] + [(1, None), (None, 1), (2, 0), (99999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    extra = [(1000, None), (1001, ""), (1002, "123 456 !!"), (1003, "abc " * 300_000), (1004, "zonk"), (None, "zonk Wöxel zonk"), (7, "zonk zonk"), (7, "zonk zonk")]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = toxicity.score(more, model).collect()
    held_out = {i: b for i, _, b in rows if i % 3 == 0}
    right = [int(r.predicted == held_out[r.doc_id]) for r in got if r.doc_id in held_out]
    assert np.mean(right) > 0.97
    # a second version of the score
    def by_hand(text):
        words = toxicity.words_of(text)
        z = model.bias
        for u, w in model.weights.items():
            c = sum(u in toxicity.units_of(x) for x in words)
            z += w * math.sqrt(min(1.0, c / (toxicity.FULL * max(1, len(words)))))
        return 1 / (1 + math.exp(-min(max(z, -35), 35)))

    by_id = {r.doc_id: r for r in got}
    for i, t in [(0, rows[0][1]), (3, rows[3][1]), *extra[:3], *extra[4:6]]:
        assert by_id[i].score == pytest.approx(by_hand(t))
    assert by_id[1000].score == by_id[1001].score == by_id[1002].score < 0.5 < by_id[1004].score and by_id[1004].predicted == by_id[None].predicted == 1
    assert len({r.score for r in got if r.doc_id == 7 and r.score > 0.5}) == 1 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(1, None)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert [tuple(r) for r in toxicity.score(docs, model).orderBy("doc_id").collect()] == [(1, 0.0, 0), (2, 0.0, 0)]


def test_toxicity_query_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op12_toxicity"](spark, SF).join(labels, "doc_id").where("held_out").collect()
    bad, good = [r for r in got if r.toxic], [r for r in got if not r.toxic]
    assert np.mean([r.predicted for r in bad]) > 0.6 and np.mean([r.predicted for r in good]) < 0.02  # a third of the toxic rows show no sign here


# --- language ----------------------------------------------------------------------------------------------


def test_language_equals_plain_nearest_centroid(spark):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices(a, k=rng.randint(2, 6))) for _ in range(rng.randint(3, 40))) for a in ("abcde", "lmnop", "vwxyz") for _ in range(25)]
    rows = [(i, t, "pqr"[i // 25]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    odd = [(500, "½ ² ³ Ⅷ ① 123 ٣"), (501, "٠١٢"), (502, "_"), (503, None), (504, ""), (505, "a"), (506, "ⅷ名"), (507, "ab " * 100_000), (None, texts[0]), (3, texts[3]), (3, texts[3])]
    got = language.predict(docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string")), model).collect()

    def by_hand(text):
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        raw = b" " + text.lower().encode().translate(language._SPACED) + b" "
        counts = [0] * language.DIMENSIONS
        for a, b, c in zip(raw, raw[1:], raw[2:], strict=False):
            counts[((a * 40503 + b * 1337 + c * 257) % 65536) >> 3] += 1
        v = [math.log1p(n) * float(w) for n, w in zip(counts, model.idf, strict=True)]
        size = math.sqrt(sum(x * x for x in v))
        near = [(sum(x * float(y) for x, y in zip(v, c, strict=True) if x) / size) for c in model.centroids]
        best = max(range(len(near)), key=lambda j: near[j])
        return model.languages[best], near[best]

    want = {i: by_hand(t) for i, t in [*enumerate(texts[::15]), *odd]}
    by_id = {r.doc_id: r for r in got}
    for i, t in [(i * 15, t) for i, t in enumerate(texts[::15])] + odd:
        lang, score = by_hand(t)
        assert by_id[i].lang_pred == lang and by_id[i].score == pytest.approx(min(max(score, 0), 1), abs=1e-5), (i, want)
    assert [by_id[i].lang_pred for i in (500, 501, 502, 503, 504)] == ["und"] * 5 and by_id[506].lang_pred != "und"
    assert sum(r.doc_id == 3 for r in got) == 3 and language.predict(docs.limit(0), model).collect() == []


# --- quality ------------------------------------------------------------------------------------------------


def likelihood(w, cuts, rows, grades, ridge):
    total = 0.05 * ridge * float((w * w).sum())
    for r, g in zip(rows, grades, strict=True):
        s = w[r].sum()
        p = [1 / (1 + math.exp(-(c - s))) for c in cuts]
        total -= math.log([*p, 1.0][g] - [0.0, *p][g])
    return total


def test_quality_fit_is_a_minimum_of_the_penalised_likelihood():
    rng = np.random.default_rng(2)
    rows = [np.flatnonzero(rng.random(8) < 0.4) for _ in range(120)]
    grades = np.array([min(2, int(len(set(r) & {0, 1, 2}) + rng.random() * 0.8)) for r in rows])
    w, cuts = quality.fit_ordinal(rows, grades, 3, rounds=3000)
    assert cuts[0] < cuts[1]
    best = likelihood(w, cuts, rows, grades, 2.0)
    for j in range(len(w)):
        for step in (-0.05, 0.05):
            moved = w.copy()
            moved[j] += step
            assert likelihood(moved, cuts, rows, grades, 2.0) > best - 1e-3
    for step in (-0.05, 0.05):
        assert likelihood(w, cuts + step, rows, grades, 2.0) > best - 1e-3


def test_quality_score_by_hand_ties_and_several_grades(spark):
    texts = ["good fine words here", "bad junk here", "good bad", "", None, "  ", "other", "good fine words here"]
    docs = spark.createDataFrame([(i, t, 1.0, True) for i, t in enumerate(texts)], "doc_id long, text string, p_tail double, kept boolean")
    weight = {quality.bucket("good"): 1.5, quality.bucket("bad"): -2.0, quality.bucket("here"): 0.25}
    model = quality.Model(weight, [-1.0, 0.5])
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    for i, s in ((0, 1.75), (1, -1.75), (2, -0.5), (6, 0.0)):
        above = [1 / (1 + math.exp(c - s)) for c in (-1.0, 0.5)]
        assert got[i].p_tail == pytest.approx(above[1]) and got[i].expected_grade == pytest.approx(sum(above)) and got[i].kept == (above[1] >= 0.5)
    assert [got[i].p_tail for i in (3, 4, 5)] == [0, 0, 0] and got[0].p_tail == got[7].p_tail
    exact = quality.score(docs, quality.Model({quality.bucket("other"): 0.5}, [-1.0, 0.5]), keep=0.5).where("doc_id = 6").first()
    assert exact.p_tail == 0.5 and exact.kept
    assert {r.doc_id for r in quality.select_rows(docs, model).collect()} == {i for i in got if got[i].kept}
    ratings = spark.createDataFrame([(0, 2), (0, 2), (0, 0), (1, 0), (2, None), (None, 1)] * 4, "doc_id long, grade int")
    fitted = quality.fit(docs, ratings)
    assert fitted.thresholds[0] < fitted.thresholds[1] and {r.doc_id for r in quality.score(docs, fitted).where("p_tail = 0").collect()} >= {3, 4, 5}


# --- repairs -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("d", [64, 1536, 2048, 4096])
def test_int8_products_are_exact(d):
    rng = np.random.default_rng(d)
    a, b = rng.integers(-127, 128, (9, d)).astype(np.int8), rng.integers(-127, 128, (70, d)).astype(np.int8)
    a[0], b[0] = 127, 127
    assert (vectors.int8_products(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()


@pytest.mark.parametrize("d", [1536, 4096])
def test_nearest_cosine_in_many_dimensions(d):
    import pandas as pd

    rng = np.random.default_rng(d)
    x = rng.integers(100, 128, (60, d)).astype(float)  # integers quantise without loss, and their cosines lie close together
    frame = pd.DataFrame({"id": range(60), "v": list(x)})
    got = vectors._cosine_tile(3)(frame.iloc[:20], frame)
    cos = np.array([vectors.cosines(a, vectors.scaled(x)) for a in vectors.scaled(x)])
    for q in range(20):
        want = sorted((-cos[q][i], i) for i in range(60) if i != q)[:3]
        assert [(-r.score, r.vec_id) for r in got[got.query_id == q].sort_values(["score", "vec_id"], ascending=[False, True]).itertuples()] == want


CLASHES = "doc_id long, text string, _sd_id int, _SD_CHUNKS string, _sd_windows int, _fd_id int, _fd_ranges string, _ss_k string, _ss_0 int, _ss_doc int, n int"


def test_clashing_names(spark):
    passage = "the quick brown fox jumps over the lazy dog and runs away from the barking hounds at dawn. " * 3
    rows = [(i, t, 1, "c", 2, 3, "r", "k", 4, 5, 6) for i, t in enumerate([passage, "before " + passage + "after", "password=hunter22 here", None, ""])]
    df = spark.createDataFrame(rows, CLASHES)
    for done in (substring_dedup.remove(df), suffix_dedup.remove(df), secret_scan.find(df).drop("spans")):
        assert done.columns == df.columns
        got = {r[0]: tuple(r) for r in done.collect()}
        assert all(got[i][2:] == rows[i][2:] for i in got) and len(got) == 5 and passage.startswith(got[0][1])
    assert {r.doc_id: len(r.spans) for r in secret_scan.find(df).collect()} == {0: 0, 1: 0, 2: 1, 3: 0, 4: 0}
    assert common.unused(["A", "_b"], "a", "_B", "c") == ["_a", "__B", "c"]


def test_one_phrase_in_many_surroundings(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 5)
    rng = random.Random(6)
    noise = lambda: "".join(rng.choices("abcdefghij ", k=rng.randint(30, 90)))
    phrase = "".join(rng.choices("klmnopqrs ", k=120))
    texts = [noise() + phrase + noise() for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.digests(df).collect()}
    for i, t in enumerate(texts):
        raw, keep = t.encode(), np.ones(len(t), bool)
        for a in range(len(raw) - 99):
            if any(raw[a : a + 100] in e.encode() for e in texts[:i]):
                keep[a : a + 100] = False
        assert got[i].n_removed == int((~keep).sum())
