"""Vector search over blocks: exact top-k products and nearest cosines.

Both searches compare a query set with all rows, in blocks. Rows are dealt into
blocks of about ``BLOCK_ROWS`` rows and queries into blocks of about
``QUERY_BYTES`` bytes; a task takes one (query block, row block) tile, so its
memory is bounded by the two block sizes whatever the table, and equal or
frequent vectors never meet in one task. A row is sent once for each query
block, so query blocks are as large as a task's memory allows. Tiles return each
query's best few candidates, which are merged by an aggregation per query.

Exact top-k (``top_products``), norm-bucketed retrieval: row blocks are ranges
of falling vector length. The queries first meet the longest rows, which gives
each a score to beat. A later bucket is skipped for a query block when no
query's length times the bucket's greatest length can reach it; within a bucket
each query's threshold divided by its length and the bucket's greatest length
is its local cosine threshold, by which the bucket is pruned on length (high
local threshold: rows are sorted, a prefix remains) or on a few coordinates
(partial products plus a Cauchy bound on the rest). What survives is verified
by whole integer products.

Nearest cosines (``nearest_cosine``), block matrix join: vectors are scaled to
int8 and tiles are multiplied as small integers; the quantisation error bounds
each cosine from both sides. Pairs whose upper bound reaches the k-th best
lower bound survive, are recomputed in double precision, and are merged by
heaps. The bounds are safe, so nothing that belongs to the result is lost. The
recomputation sums each row on its own and scales by powers of two first, so
equal vectors get equal scores wherever they stand, and vectors of any magnitude
have a cosine.

Defined results: vectors that are null, hold null or non-finite components, (for
cosines) are zero, or whose dimension differs from the most frequent one's
(the smallest, if several) take no part. Ties go to the smaller id. A row is no
candidate of its own query. Ids are expected to be distinct; a repeated id is
one row for each repetition, none a candidate of another. Extra columns are
ignored; an empty table has no results. Scaled components of more than 63 bits,
and products of more, count as the nearest 64-bit integer. Vectors may have any
number of dimensions.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK_ROWS = 8192
#: Bytes of a block of query vectors, as doubles.
QUERY_BYTES = 16 << 20
#: Coordinates looked at by coordinate pruning.
FOCUS = 16
#: Coordinates of int8 values that are summed in float32 (127 x 127 x 1,024 < 2^24).
WIDTH = 1024
#: Integer components are multiplied as doubles below this bound on a product.
EXACT = float(1 << 52)
_LONG = (1 << 63) - 1


def usable(df: DataFrame, id_col: str, vec_col: str, nonzero: bool) -> DataFrame:
    """(id, v array<double>) of the vectors that take part."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & (F.size("v") > 0))
    return rows.where(F.exists("v", lambda x: x != 0)) if nonzero else rows


def dimension(rows: DataFrame) -> int:
    """The most frequent dimension (one small row per dimension reaches the driver)."""
    got = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return got[0]["d"] if got else 0


def blocks_of(n: int, block: int) -> int:
    return max(1, -(-n // block))


def queries_of(d: int) -> int:
    """Queries in a block, by the dimension."""
    return max(256, QUERY_BYTES // (8 * max(1, d)))


def all_pairs(spark: SparkSession, n_q: int, n_rows: int) -> DataFrame:
    """(qb, rb) of every query block and row block, from their counts."""
    k = F.col("id")
    return spark.range(n_q * n_rows).select(F.pmod(k, F.lit(n_q)).cast("int").alias("qb"), F.floor(k / F.lit(n_q)).cast("int").alias("rb"))


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def best(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> list[tuple[float, int]]:
    """The k best (score, id) by falling score, then rising id, without ``own``."""
    ok = ids != own
    ids, scores = ids[ok], scores[ok]
    if len(ids) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= edge
        ids, scores = ids[near], scores[near]
        if len(ids) > 4 * k:  # many ties at the edge
            top = scores > edge
            ties = np.sort(ids[~top])[:k]
            ids, scores = np.concatenate([ids[top], ties]), np.concatenate([scores[top], np.full(len(ties), edge)])
    return heapq.nsmallest(k, zip((-scores).tolist(), ids.tolist(), strict=True))


def tiles(queries: DataFrame, rows: DataFrame, pairs: DataFrame, fn, schema: str) -> DataFrame:
    """Run ``fn(query rows, row rows)`` on each (qb, rb) of ``pairs``.

    A query goes to the tiles of its block, a row likewise. The number of rows
    sent is (rows x query blocks + queries x row blocks), the block matrix
    product's cost.
    """
    fresh = lambda x: x.select(*[F.col(c).alias(c) for c in x.columns])  # noqa: E731  both sides come from one table
    q = fresh(fresh(queries).join(fresh(pairs), "qb"))
    r = fresh(fresh(rows).join(fresh(pairs), "rb"))
    return q.groupBy("qb", "rb").cogroup(r.groupBy("qb", "rb")).applyInPandas(fn, schema)


def merged(found: DataFrame, k: int, score_type: str) -> DataFrame:
    """Best k of the tiles' candidates for each query, ranked."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.col("score").cast(score_type).alias("score"))
    )


# --- exact top-k products -------------------------------------------------------------


def _prune(q: np.ndarray, x: np.ndarray, lengths: np.ndarray, rest: np.ndarray, floor: float) -> np.ndarray:
    """Rows (sorted by falling length) whose product with ``q`` may reach ``floor``."""
    size = float(np.sqrt(q @ q))
    if floor <= 0 or size == 0:
        return np.arange(len(x))
    local = floor / (size * lengths[0]) if lengths[0] else np.inf
    slack = 1e-9 * (floor + size * lengths[0] + 1)
    n = int(np.searchsorted(-lengths, -(floor - slack) / size, "right"))  # length pruning
    if local > 0.9 or n < 64:
        return np.arange(n)
    tail = np.sqrt(max(0.0, q[FOCUS:] @ q[FOCUS:]))  # coordinate pruning on the first FOCUS coordinates
    bound = x[:n, :FOCUS] @ q[:FOCUS] + tail * rest[:n]
    return np.flatnonzero(bound >= floor - slack)


def _products(k: int):
    def fn(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(r):
            whole = stacked(r["v"])  # integers
            x = whole.astype(np.float64)
            lengths = np.sqrt((x * x).sum(1))
            order = np.lexsort((r["id"].to_numpy(), -lengths))
            whole, x, ids, lengths = whole[order], x[order], r["id"].to_numpy()[order], lengths[order]
            # coordinates with the largest spread come first, for coordinate pruning
            axes = np.argsort(-(x * x).sum(0), kind="stable")
            asked = stacked(q["v"])
            xr, qs = x[:, axes], asked[:, axes].astype(np.float64)
            rest = np.sqrt((xr[:, FOCUS:] ** 2).sum(1))
            exact = float(lengths[0]) * float(np.sqrt((qs * qs).sum(1)).max()) < EXACT
            for own, floor, v, ints in zip(q["id"].to_numpy(), q["floor"].to_numpy(), qs, asked, strict=True):
                at = _prune(v, xr, lengths, rest, floor)
                if not len(at):
                    continue
                if exact:
                    s = (xr if len(at) == len(xr) else xr[at]) @ v
                else:  # beyond the integers that doubles hold
                    s = whole[at].astype(object) @ ints.astype(object)
                out += [(own, i, max(-_LONG - 1, min(_LONG, int(-s)))) for s, i in best(ids[at], s, own, k) if -s >= floor]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return fn


def top_products(df: DataFrame, is_query, k: int, scale: float = 1024.0, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = BLOCK_ROWS, query_block: int | None = None) -> DataFrame:
    """The k largest integer products floor(scale * q) . floor(scale * x) of each query.

    is_query: a condition on the column ``id``. Returns query_id, rank, vec_id, score.
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col, nonzero=False).withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(scale))))
    d = dimension(rows)
    rows = rows.where(F.size("v") == d)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    measured = rows.withColumn("len2", square)
    # ranges of falling length; the hash splits equal lengths evenly
    ranged = measured.repartitionByRange(blocks_of(measured.count(), block_rows), F.desc("len2"), F.xxhash64("id"))
    ranged = cut(ranged.withColumn("rb", F.spark_partition_id()))
    queries = ranged.where(is_query).select("id", "v", "len2")
    n_q = blocks_of(queries.count(), query_block or queries_of(d))
    queries = queries.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(n_q)).cast("int"))
    stats = ranged.groupBy("rb").agg(F.max("len2").alias("most"))  # one row per bucket
    first, last = stats.agg(F.max_by("rb", F.struct("most", -F.col("rb"))), F.max("rb")).first()
    schema = "query_id long, vec_id long, score long"
    cand = ranged.select("rb", F.col("id"), F.col("v"))
    blocks = all_pairs(spark, n_q, (last or 0) + 1)
    opening = blocks.where(F.col("rb") == F.lit(first or 0))  # one bucket for each query block
    seen = cut(tiles(queries.withColumn("floor", F.lit(float("-inf"))), cand, opening, _products(k), schema))
    floors = merged(seen, k, "long").groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("f"))
    # a double may lie above the integer it stands for
    armed = queries.join(floors, "id", "left").withColumn("floor", F.coalesce(F.col("f") - F.abs("f") * 1e-12, F.lit(float("-inf")))).drop("f")
    # a bucket is left out for a query block when no query of the block can reach its floor there
    reach = armed.groupBy("qb").agg(F.min(F.when(F.col("floor") > 0, F.col("floor") / F.sqrt("len2")).otherwise(0.0)).alias("least"))
    later = blocks.where(F.col("rb") != F.lit(first or 0)).join(reach, "qb").join(stats, "rb")  # blocks, not rows
    pairs = later.where(F.sqrt("most") >= F.col("least") * (1 - 1e-9)).select("qb", "rb")
    rest = tiles(armed, cand, pairs, _products(k), schema)
    return merged(seen.unionByName(rest), k, "long")


# --- nearest cosines ------------------------------------------------------------------


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their greatest component to [1/2, 1)."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def lengths_of(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as int8, their scale, and the length of what quantising loses."""
    unit = x / lengths_of(x)[:, None]
    scale = np.abs(unit).max(1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    lost = np.sqrt(((unit - q * scale[:, None]) ** 2).sum(1))
    return q, scale, lost


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of ``a`` with each row of ``b`` (both :func:`scaled`) in double precision.

    Each row is summed on its own, so the result does not depend on the row's place.
    """
    return (b * a).sum(1) / (lengths_of(a[None, :]) * lengths_of(b))


def int8_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows: 1,024 coordinates sum to less than 2^24 in float32, and these sums are added as doubles."""
    out = np.zeros((len(a), len(b)))
    for lo in range(0, a.shape[1], WIDTH):
        out += a[:, lo : lo + WIDTH].astype(np.float32) @ b[:, lo : lo + WIDTH].astype(np.float32).T
    return out


def _cosine_tile(k: int):
    def fn(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(r):
            x, qs = scaled(stacked(r["v"])), scaled(stacked(q["v"]))
            x8, xs, xl = quantised(x)
            q8, qsc, ql = quantised(qs)
            ids = r["id"].to_numpy()
            for lo in range(0, len(q), 256):
                for j, approx in enumerate(int8_products(q8[lo : lo + 256], x8), lo):
                    own = int(q["id"].iat[j])
                    cos = approx * xs * qsc[j]
                    # |q.x - q'.x'| <= |q'||x - x'| + |x||q - q'|, with |q'| <= 1 + |q - q'|
                    err = (1 + ql[j]) * xl + ql[j] + 1e-9
                    lower = np.where(ids == own, -np.inf, cos - err)
                    edge = np.partition(lower, len(lower) - k)[len(lower) - k] if len(lower) > k else -np.inf
                    at = np.flatnonzero((cos + err >= edge) & (ids != own))
                    if len(at):
                        out += [(own, i, -s) for s, i in best(ids[at], cosines(qs[j], x[at]), own, k)]
        frame = pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
        return frame.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return fn


def nearest_cosine(df: DataFrame, is_query, k: int, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = BLOCK_ROWS, query_block: int | None = None) -> DataFrame:
    """The k nearest rows of each query by cosine: query_id, rank, vec_id, score."""
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col, nonzero=True)
    d = dimension(rows)
    rows = rows.where(F.size("v") == d)
    n_rows = blocks_of(rows.count(), block_rows)
    queries = rows.where(is_query)
    n_q = blocks_of(queries.count(), query_block or queries_of(d))
    dealt = rows.withColumn("rb", F.pmod(F.xxhash64("id"), F.lit(n_rows)).cast("int"))
    asked = queries.withColumn("qb", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_q)).cast("int"))
    found = tiles(asked, dealt, all_pairs(spark, n_q, n_rows), _cosine_tile(k), "query_id long, vec_id long, score double")
    return merged(found, k, "double")
