"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Ratings are ordered grades 0..K-1 (here 0 junk, 1 toxic, 2 clean). One weight
vector over hashed text features is shared by all grades; ordered thresholds
turn its score into P(grade <= k) = sigmoid(threshold_k - score). The operator
reports the expected grade and the tail probability P(grade >= ``select``), by
which documents are selected.

Defined results: a null text, or one without a word, has grade 0 and tail
probability 0 (rejected). Without ratings nothing can be judged: the tail
probability is 1 and every text with a word is kept. Null ratings are ignored;
several ratings of one id count each, on one of its texts (the smallest).
Every row is judged on its own whole text, so repeated rows get equal results;
a tail probability of exactly ``keep`` is kept. Extra columns are ignored by
:func:`score` and handed through by :func:`select_rows`.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, map_texts

#: Hashed feature space; wide, so that words of long texts rarely meet by chance.
BUCKETS = 1 << 24
#: The model is fitted on at most so many rated texts (in hash order of the id).
SAMPLE_ROWS = 8000
#: Features in fewer rated texts carry no weight.
LEAST_TEXTS = 4
GRADES = 3
#: Documents whose P(grade >= SELECT) is at least KEEP are kept.
SELECT, KEEP = 2, 0.5
#: Words whose weight a worker remembers.
CACHE_WORDS = 100_000

_TRIM = ".,;:!?\"'()[]{}<>|#$%&*@+-_=~^/\\`"
_MARKS = "|#$%&*@+=~^<>{}[]_\\"


@dataclass
class Model:
    weights: dict[int, float]
    thresholds: list[float]


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode(errors="replace")) & (BUCKETS - 1)


def shapes(text: str, words: list[str], distinct: int) -> list[str]:
    """Features of a text's form: marks, repetition, word length, digits."""
    n = len(words)
    out = [f"\x01m{c}{min(8, int(8 * text.count(c) / n))}" for c in _MARKS if 20 * text.count(c) >= n]
    out.append(f"\x01r{int(10 * distinct / n) if n >= 20 else -1}")
    out.append(f"\x01l{min(12, len(text) // n)}")
    out.append(f"\x01n{min(5, n.bit_length() // 2)}")
    return out


def features(text: str) -> set[int]:
    words = text.lower().split()
    names = set(words)
    out = {bucket(s) for w in names if (s := w.strip(_TRIM))}
    return out | {bucket(f) for f in shapes(text, words, len(names))}


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, rounds: int = 250, ridge: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the penalised log-likelihood.

    rows: indexes of the binary features of each text. Thresholds are a first
    value and positive steps, so they stay ordered.
    """
    size = 1 + max((int(r.max()) for r in rows if len(r)), default=0)
    flat = np.concatenate(rows) if rows else np.zeros(0, int)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    share = np.array([(grades <= k).mean() for k in range(n_grades - 1)]).clip(0.01, 0.99)
    first = np.log(share / (1 - share))
    p = np.concatenate([np.zeros(size), first[:1], np.log(np.maximum(np.diff(first), 0.05))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -35, 35)))
    for t in range(1, rounds + 1):
        w, steps = p[:size], np.exp(p[size + 1 :])
        cuts = np.concatenate([[-np.inf], p[size] + np.concatenate([[0], np.cumsum(steps)]), [np.inf]])
        score = np.bincount(owner, w[flat], len(rows))
        hi, lo = cuts[grades + 1] - score, cuts[grades] - score
        fh, fl = np.where(np.isinf(hi), 1.0, sigmoid(hi)), np.where(np.isinf(lo), 0.0, sigmoid(lo))
        mass = np.maximum(fh - fl, 1e-9)
        dh, dl = fh * (1 - fh) / mass, fl * (1 - fl) / mass  # d log mass / d hi, -d lo
        g_score = dh - dl  # of the negative log-likelihood
        g = np.zeros_like(p)
        g[:size] = np.bincount(flat, g_score[owner], size) + ridge * w * 0.1
        for k in range(n_grades - 1):
            g_cut = -(dh[grades == k].sum() - dl[grades == k + 1].sum())
            g[size] += g_cut
            g[size + 1 : size + 1 + k] += g_cut * steps[:k]
        g /= max(1, len(rows))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return p[:size], p[size] + np.concatenate([[0], np.cumsum(np.exp(p[size + 1 :]))])


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", sample_rows: int = SAMPLE_ROWS, grades: int = GRADES) -> Model:
    """Fit on at most ``sample_rows`` rated texts; only their hashed features reach the driver."""
    rated = (
        ratings.where(F.col(grade_col).isNotNull() & F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade"))
        .orderBy(F.xxhash64("id"), "id", "grade")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.array(sorted(features(t)), np.uint32).tobytes() if t.split() else b"" for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(map(str, batch.column(0).to_pylist()), pa.string()), pa.array(found, pa.binary()), batch.column(2)], ["key", "f", "grade"])

    # an id may repeat without bound: one text of each
    picked = texts.join(F.broadcast(rated.select("id").distinct()), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    picked = picked.join(F.broadcast(rated), "id")  # at most sample_rows rows
    got = [r for r in map_texts(picked, ["id", "text", "grade"], extract, "key string, f binary, grade int").toArrow().to_pylist() if r["f"]]
    if not got:
        return Model({}, [])
    got.sort(key=lambda r: (r["key"], r["grade"]))
    rows = [np.frombuffer(r["f"], np.uint32) for r in got]
    y = np.array([min(max(r["grade"], 0), grades - 1) for r in got])
    names, inverse, count = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    renamed = np.where(count >= LEAST_TEXTS, np.cumsum(count >= LEAST_TEXTS) - 1, -1)
    ends = np.cumsum([len(r) for r in rows])
    dense = [(x := renamed[part])[x >= 0] for part in np.split(inverse, ends[:-1])]
    w, cuts = fit_ordinal(dense, y, grades)
    kept = names[count >= LEAST_TEXTS]
    return Model({int(b): float(x) for b, x in zip(kept, w, strict=False) if abs(x) > 1e-4}, [float(c) for c in cuts])


class _Weights(dict):
    """Weight of each word as it stands in a text, remembered while few."""

    def __init__(self, weights: dict[int, float]):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        s = word.strip(_TRIM)
        got = self.weights.get(bucket(s), 0.0) if s else 0.0
        if len(self) < CACHE_WORDS and len(word) < 64:
            self[word] = got
        return got


def judge(model: Model, weights: _Weights, texts: list[str | None]) -> list[np.ndarray]:
    """P(grade > k) of each text, for k from 0."""
    cuts, out = np.array(model.thresholds), []
    for text in texts:
        words = text.lower().split() if text else []
        if not words:
            out.append(np.zeros(max(1, len(cuts))))
            continue
        if not len(cuts):
            out.append(np.ones(GRADES - 1))
            continue
        names = set(words)
        parts = dict.fromkeys(bucket(s) for w in names if weights[w] and (s := w.strip(_TRIM)))
        s = sum(model.weights[b] for b in parts)
        s += sum(model.weights.get(bucket(f), 0.0) for f in shapes(text, words, len(names)))
        out.append(1 / (1 + np.exp(np.clip(cuts - s, -35, 35))))
    return out


def _judging(docs: DataFrame, model: Model, column: int):
    """(name of what a worker keeps, function from a batch to P(grade > k) of its texts)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the fitting sample
    name = f"quality {uuid.uuid4().hex}"

    def of(batch: pa.RecordBatch) -> list[np.ndarray]:
        return judge(shared.value, held(name, lambda: _Weights(shared.value.weights)), batch.column(column).to_pylist())

    return name, of


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", select: int = SELECT, keep: float = KEEP) -> DataFrame:
    """``id_col``, expected_grade, p_tail and kept for every document; one narrow pass."""
    name, of = _judging(docs, model, 1)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        above = of(batch)
        tail = [float(a[min(select, len(a)) - 1]) for a in above]
        columns = [batch.column(0), pa.array([float(a.sum()) for a in above], pa.float64()), pa.array(tail, pa.float64()), pa.array([x >= keep for x in tail], pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, ["id", "expected_grade", "p_tail", "kept"])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, expected_grade double, p_tail double, kept boolean"
    return map_texts(docs, [id_col, text_col], run, schema, 256, name).withColumnRenamed("id", id_col)


def select_rows(docs: DataFrame, model: Model, text_col: str = "text", select: int = SELECT, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that the model keeps, with all their columns.

    Rows are dropped within the Python worker, in small slices, so rejected
    texts do not come back and kept ones are not gathered.
    """
    names = docs.columns
    name, of = _judging(docs, model, names.index(text_col))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = [bool(a[min(select, len(a)) - 1] >= keep) for a in of(batch)]
        return batch.filter(pa.array(good, pa.bool_()))

    return map_texts(docs, [f"`{c}`" for c in names], run, docs.schema, 256, name)


def grades_of_labels(labels: DataFrame) -> DataFrame:
    """Grades from the labels table: 2 clean, 1 toxic, 0 of low quality."""
    q, t = F.col("quality"), F.coalesce(F.col("toxic"), F.lit(0))
    return labels.select("doc_id", F.greatest(2 * q - t, F.lit(0)).alias("grade"))
