"""Importance resampling towards a target distribution.

Texts are bags of hashed runs of words. The log ratio of a bucket's share in the
target and in the source, smoothed by one, is the bucket's gain; a document's
weight is the sum of its features' gains, gathered from one array. The weight plus
a Gumbel number drawn by a hash of the id is the document's score, and the
documents with the highest scores are a sample, without replacement, in proportion
to exp(weight).

1. Buckets are counted in the tasks (one array each) and added up by key.
2. Documents are scored in one narrow pass; the scores are stored.
3. The k-th best key (score falling, id rising, row) is found exactly by distributed
   radix selection: a round counts the rows under each value of the highest digit
   in which the remaining rows differ, and keeps the value that holds the k-th.
   At most ``1 << DIGIT`` counts reach the driver in a round.
4. Only rows up to that key are range-sorted; a row's rank is its place in its range
   and the rows in the ranges before. No row is ranked in a single task.

Words: A-Z are lower-cased, every other ASCII character but digits and letters
separates, and so nothing beyond ASCII does.

Defined results: a null or empty text has no features, weight 0, and is not drawn
when words are asked for. Ties go to the smaller id, a null id comes last; rows with
equal id and score are drawn in the order in which they are stored. Every row is
returned, drawn or not (rank null). Columns other than id and text are ignored. An
empty target or source counts 0 in each bucket; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, held, map_texts, release, shuffle_width, slices

BUCKETS = 10_000
#: Runs of one to so many words are features.
LONGEST = 1
#: Percent of the documents with at least ``LEAST_WORDS`` words that are drawn.
PERCENT, LEAST_WORDS = 10, 20
SEED = "2024"
#: Bits of a digit in radix selection.
DIGIT = 16
#: Words whose bucket a worker remembers (some 30 MB).
CACHE_WORDS = 200_000

_LOWERED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_BIAS = 1 << 63
_LAST = (1 << 63) - 1


class _Buckets(dict):
    """Bucket of each word, remembered while few."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        got = zlib.crc32(word) % self.buckets
        if len(word) <= 64:
            if len(self) > CACHE_WORDS:
                self.clear()
            self[word] = got
        return got


def _memo_name(buckets: int) -> str:
    return f"words in {buckets} buckets"


def _memo(buckets: int) -> _Buckets:
    """What this worker remembers for so many buckets."""
    return held(_memo_name(buckets), lambda: _Buckets(buckets))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWERED).split()


def features(words: list[bytes], memo: _Buckets, longest: int) -> np.ndarray:
    """The bucket of each run of words, repeats included."""
    found = [np.fromiter(map(memo.__getitem__, words), np.int64, len(words))]
    if longest > 1:
        sums = [zlib.crc32(w) for w in words]
        for n in range(2, longest + 1):  # a run's sum goes on from that of the run without its last word
            sums = [zlib.crc32(b" " + words[i + n - 1], sums[i]) for i in range(len(words) - n + 1)]
            found.append(np.array(sums, np.int64) % memo.buckets)
    return np.concatenate(found)


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all texts in each bucket: one array in each task, added up by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(_memo_name(buckets))
        memo = _memo(buckets)
        total = np.zeros(buckets, np.int64)
        for piece in slices(batches):
            for text in _texts(piece.column(0)):
                total += np.bincount(features(words_of(text), memo, longest), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in docs.select(text_col).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(key: str, seed: str = SEED) -> int:
    """Thousandths of a Gumbel number drawn by the key, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, seed: str = SEED) -> DataFrame:
    """id, n_words, n_features, weight and score of every row; one narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        g = shared.value
        memo = _memo(len(g))
        n_words, n_features, weights, scores = [], [], [], []
        for key, text in zip(piece.column(1).to_pylist(), _texts(piece.column(2)), strict=True):
            words = words_of(text)
            at = features(words, memo, longest)
            n_words.append(len(words))
            n_features.append(len(at))
            weights.append(int(g[at].sum()))
            scores.append(weights[-1] + gumbel(key, seed))
        return pa.RecordBatch.from_arrays([piece.column(0), *[pa.array(x, pa.int64()) for x in (n_words, n_features, weights, scores)]], ["id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(rows, ["id", "key", "text"], run, f"id {kind}, n_words long, n_features long, weight long, score long", keep=_memo_name(len(gain)))


def kth_key(rows: DataFrame, parts: list[str], k: int) -> tuple[int, ...]:
    """The k-th smallest of the keys made of the long columns ``parts`` (k from 1), or a key at which as many rows end.

    Distributed radix selection: rounds of counts by digit over the rows that can
    still hold it. Rows have to be stored.
    """
    out: list[int] = []
    left = rows.select(*parts)
    for n, part in enumerate(parts):
        least, most, count = left.agg(F.min(part), F.max(part), F.count(F.lit(1))).first()
        if count == k:  # all that is left
            return (*out, most, *[_LAST] * (len(parts) - n - 1))
        biased = F.col(part).bitwiseXOR(F.lit(-_BIAS))
        known = least + _BIAS
        shift = ((least + _BIAS) ^ (most + _BIAS)).bit_length()
        while shift > 0:
            width = min(DIGIT, shift)
            shift -= width
            digit = F.shiftrightunsigned(biased, shift).bitwiseAND(F.lit((1 << width) - 1))
            counts = sorted((r["d"], r["count"]) for r in left.groupBy(digit.alias("d")).count().collect())  # at most 1 << DIGIT rows
            for d, c in counts:
                if k <= c:
                    break
                k -= c
            known = (known >> (shift + width) << (shift + width)) | d << shift
            left = left.where(digit == d)
            if c == k:  # the digit's rows are all within
                return (*out, (known | ((1 << shift) - 1)) - _BIAS, *[_LAST] * (len(parts) - n - 1))
        out.append(known - _BIAS)
        left = left.where(F.col(part) == out[-1])
    return tuple(out)


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 1) by ``order``: range-sorted, with each range's rows before it added."""
    spark = rows.sparkSession
    ranges = rows.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    placed = cut(ranges.withColumn("_at", F.monotonically_increasing_id()))  # the range's number, then the place in it
    range_of = F.shiftright("_at", 33)
    sizes = sorted(tuple(r) for r in placed.groupBy(range_of.alias("_range")).count().collect())  # a row for each partition
    starts = [(n, sum(c for _, c in sizes[:i])) for i, (n, _) in enumerate(sizes)]
    before = spark.createDataFrame(starts, "_range long, _before long")
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_range", range_of).join(F.broadcast(before), "_range").withColumn("rank", F.col("_before") + within + 1).drop("_at", "_range", "_before")


def _up_to(parts: list[str], key: tuple[int, ...]) -> Column:
    """Whether a row's key is at most ``key``."""
    out = F.lit(True)
    for part, value in reversed(list(zip(parts, key, strict=True))):
        out = (F.col(part) < value) | ((F.col(part) == value) & out)
    return out


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: str = SEED,
) -> DataFrame:
    """``id_col`` (whole number), n_features, weight, score and rank (null: not drawn) of every row of ``docs``."""
    gain = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_col, buckets, longest))
    # keys rise as rows get worse: falling score, id (a null one last), stored row
    keyed = score(docs, gain, id_col, text_col, longest, seed).withColumns(
        {"_score": F.bitwise_not("score"), "_id": F.coalesce(F.col("id").cast("long"), F.lit(_LAST)), "_row": F.monotonically_increasing_id()}
    )
    rows = cut(keyed)
    eligible = F.col("n_words") >= least_words
    drawn = rows.where(eligible).count() * percent // 100
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    if not drawn:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    parts = ["_score", "_id", "_row"]
    taken = eligible & _up_to(parts, kth_key(rows.where(eligible), parts, drawn))
    others = rows.where(~taken).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked(rows.where(taken), parts).select(*columns, "rank").unionByName(others)


def duckdb_sql() -> str:
    """The query in DuckDB SQL, with the checksum computed byte by byte for each distinct word."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""WITH RECURSIVE crc(i, c, n) AS (SELECT i, i::BIGINT, 0 FROM range(256) r(i) UNION ALL SELECT i, {step}, n + 1 FROM crc WHERE n < 8),
      tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM crc WHERE n = 8),
      d AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents),
      dw AS MATERIALIZED (SELECT doc_id, unnest(w) AS word FROM d),
      bw AS MATERIALIZED (SELECT unnest({words}) AS word FROM benchmark),
      hashed AS MATERIALIZED (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(word))), lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::INT, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket FROM (SELECT DISTINCT word FROM (SELECT word FROM dw UNION ALL SELECT word FROM bw)), tab),
      s AS (SELECT bucket, count(*) AS n FROM dw JOIN hashed USING (word) GROUP BY bucket),
      t AS (SELECT bucket, count(*) AS n FROM bw JOIN hashed USING (word) GROUP BY bucket),
      g AS MATERIALIZED (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + {BUCKETS})::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM s FULL JOIN t USING (bucket)),
      w AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM dw JOIN hashed USING (word) JOIN g USING (bucket) GROUP BY doc_id),
      sc AS (SELECT doc_id, len(d.w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN w USING (doc_id)),
      o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM sc WHERE n_features >= {LEAST_WORDS})
      SELECT doc_id, n_features, weight, score, CASE WHEN r <= (SELECT count(*) * {PERCENT} // 100 FROM o) THEN r END AS rank FROM sc LEFT JOIN o USING (doc_id)"""
