"""Vector searches against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import vectors


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 24)) * rng.lognormal(size=(400, 1))
    x[50:90] = x[10]  # ties
    x[100] = 0
    return [(int(i), [float(v) for v in r.astype(np.float32)], "e") for i, r in enumerate(x)]


ODD = [(1000, None, "e"), (1001, [float("nan")] * 24, "e"), (1002, [None] + [1.0] * 23, "e"), (1003, [1.0, 2.0], "e"), (1004, [float("inf")] * 24, "e"), (None, [1.0] * 24, "e")]
SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, queries, k, integer):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows])
    out = []
    y = np.floor(1024 * x) if integer else x
    size = np.sqrt((y * y).sum(1))
    for q in queries:
        s = y @ y[ids == q][0]
        if not integer:
            s = s / (size * size[ids == q])
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out += [(q, n + 1, int(ids[i]), s[i]) for n, i in enumerate(order)]
    return out


@pytest.mark.parametrize("block", [37, 5000])
def test_top_products(spark, rows, block):
    df = spark.createDataFrame(rows + ODD, SCHEMA)
    got = vectors.top_products(df, F.col("id") % 20 == 0, 7, block_rows=block, query_block=6)
    want = brute(rows, [r[0] for r in rows if r[0] % 20 == 0], 7, True)
    assert sorted(map(tuple, got.collect())) == [(q, n, i, int(s)) for q, n, i, s in want]


@pytest.mark.parametrize("block", [37, 5000])
def test_nearest_cosine(spark, rows, block):
    df = spark.createDataFrame(rows + ODD, SCHEMA)
    got = sorted(map(tuple, vectors.nearest_cosine(df, F.col("id") % 20 == 0, 5, block_rows=block, query_block=6).collect()))
    known = [r for r in rows if any(r[1])]
    want = brute(known, [r[0] for r in known if r[0] % 20 == 0], 5, False)
    assert [(a, b) for a, b, _, _ in got] == [(a, b) for a, b, _, _ in want]
    assert all(abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, want))
    copies = {i for i, _, _ in rows if 50 <= i < 90 or i == 10}
    for q in {g[0] for g in got}:  # copies of one vector rank by id, whatever block they are in
        mine = [g for g in got if g[0] == q]
        assert [g[2] for g in mine] == [w[2] for w in want if w[0] == q] or q in copies
        if q in copies:
            assert [g[2] for g in mine] == sorted(copies - {q})[:5] and len({g[3] for g in mine}) == 1


@pytest.mark.parametrize("block", [50, 5000])
def test_ties_rank_by_id(spark, block):
    rng = np.random.default_rng(3)
    v, w = rng.normal(size=(2, 64)).tolist()
    df = spark.createDataFrame([(i, v if i < 303 else w) for i in range(310)], "vec_id long, embedding array<double>")
    got = vectors.nearest_cosine(df, F.col("id") % 100 == 0, 5, block_rows=block, query_block=2).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in got if r["query_id"] == 0] == [1, 2, 3, 4, 5]
    assert [r["vec_id"] for r in got if r["query_id"] == 200] == [0, 1, 2, 3, 4]
    assert len({r["score"] for r in got}) == 1
    got = vectors.top_products(df, F.col("id") % 100 == 0, 5, block_rows=block, query_block=2).where("query_id = 300").orderBy("rank").collect()
    if len({r["score"] for r in got}) == 1:
        assert [r["vec_id"] for r in got] == [0, 1, 2, 3, 4]


def test_extreme_magnitudes(spark):
    tiny = [[1e-200, 0.0], [1e-200, 1e-200], [0.0, 3e-320], [1e200, 1e199], [5.0, 5.0]]
    df = spark.createDataFrame(list(enumerate(tiny)), "vec_id long, embedding array<double>")
    got = vectors.nearest_cosine(df, F.col("id") == 1, 5).orderBy("rank").collect()
    assert [r["vec_id"] for r in got][:2] == [4, 3] and len(got) == 4 and all(0 < r["score"] < 1 + 1e-12 for r in got)
    big = [[(2**30 + 1) / 1024, (2**30 + 3) / 1024], [(2**30 + 7) / 1024, 1 / 1024], [(2**30 + 5) / 1024, 3 / 1024], [float(2**60), -float(2**60)], [float(2**60), float(2**60)]]
    df = spark.createDataFrame(list(enumerate(big)), "vec_id long, embedding array<double>")
    got = vectors.top_products(df, F.col("id") == 0, 9).orderBy("rank").collect()
    exact = {i: sum(int(1024 * a) * int(1024 * b) for a, b in zip(big[0], v, strict=True)) for i, v in enumerate(big)}
    assert {r["vec_id"]: r["score"] for r in got if r["vec_id"] in (1, 2)} == {1: exact[1], 2: exact[2]}
    assert got[0]["vec_id"] == 4 and got[0]["score"] == (1 << 63) - 1  # beyond 64 bits: the nearest


def test_repeated_ids(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], "a"), (1, [1.0, 1.0], "b"), (1, [1.0, 1.0], "b"), (0, [0.0, 1.0], "c")], SCHEMA)
    for f in (vectors.top_products, vectors.nearest_cosine):
        got = f(df, F.col("id") == 1, 9).collect()
        assert {r["vec_id"] for r in got} == {0} and len(got) == 4


def test_few_rows(spark):
    one = spark.createDataFrame([(0, [1.0, 0.0], "")], SCHEMA)
    none = one.limit(0)
    for f in (vectors.top_products, vectors.nearest_cosine):
        assert f(one, F.col("id") >= 0, 3).count() == 0
        assert f(none, F.col("id") >= 0, 3).count() == 0
    three = spark.createDataFrame([(0, [1.0, 0.0], ""), (1, [0.0, 1.0], ""), (2, [-1.0, 0.5], "")], SCHEMA)
    assert [r["vec_id"] for r in vectors.top_products(three, F.col("id") == 0, 5).orderBy("rank").collect()] == [1, 2]
    assert [r["vec_id"] for r in vectors.nearest_cosine(three, F.col("id") == 0, 5).orderBy("rank").collect()] == [1, 2]
