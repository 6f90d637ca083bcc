"""Language identification by nearest centroids over TF-IDF character n-grams.

Texts become L2-normalised TF-IDF vectors of hashed byte trigrams. Each
language is described by a few centroids (spherical k-means over a bounded
sample of labelled texts). A text gets the language of the centroid with the
largest cosine; it is *rejected* when that cosine lies below what the
centroid's own members show (distance-based rejection).

Defined results: a null text, or one without a letter, is ``und`` with score 0;
without any labelled text there are no centroids and every text is ``und``.
Ties go to the alphabetically first language. Extra columns are ignored;
repeated rows are predicted each on its own, and so are rows with a null id.
Texts of any length are looked at whole; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_texts

#: Hashed dimensions of a vector.
DIMENSIONS = 8192
#: The classifier is fitted on at most so many labelled texts of each language.
SAMPLE_PER_LANGUAGE = 400
#: Chosen ids that are broadcast; more are shuffled.
BROADCAST_IDS = 1 << 20
#: Centroids of each language.
CLUSTERS = 4
#: A text is rejected below this quantile of its centroid's own similarities...
REJECT_QUANTILE = 0.01
#: ...less this margin.
REJECT_MARGIN = 0.1

#: ASCII bytes that are no letters count as spaces.
_SPACED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # (centroids, DIMENSIONS)
    idf: np.ndarray
    floor: np.ndarray  # least similarity that is not rejected, by centroid


def lettered(text: str) -> bool:
    """Whether a letter of any script occurs (numerals such as one half or Roman eight are none)."""
    return any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """Hashed counts of the byte trigrams of the lower-cased text."""
    raw = np.frombuffer(b" " + text.lower().encode(errors="replace").translate(_SPACED) + b" ", np.uint8).astype(np.uint16)
    code = raw[:-2] * np.uint16(40503) + raw[1:-1] * np.uint16(1337) + raw[2:] * np.uint16(257)
    return np.bincount(code >> 3, minlength=DIMENSIONS)


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(gram_counts(text).astype(np.float32)) * idf
    n = float(np.linalg.norm(v))
    return v / n if n else v


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """At most ``per_language`` labelled texts of each language, in hash order of the id.

    The ranking sees ids and languages only (Spark limits each group before the
    shuffle); the chosen ids are broadcast up to ``BROADCAST_IDS``.
    """
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    order = Window.partitionBy("lang").orderBy("h", "id")
    ids = cut(
        known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"))
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= per_language)
        .select("id")
        .distinct()
    )
    rows = known.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means with farthest-point starts; deterministic for given rows."""
    seeds = [int(np.argmax(x @ x.mean(0)))]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(np.argmin((x @ x[seeds].T).max(1))))
    c = x[seeds]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        c = np.stack([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
    clusters: int = CLUSTERS,
) -> Model:
    """Fit on a bounded sample; what reaches the driver is sparse counts of its texts."""

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, idx, cnt, lang = [], [], [], []
        for i, text, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if lettered(text):
                c = gram_counts(text)
                at = np.flatnonzero(c)
                keys.append(str(i))
                idx.append(at.astype(np.uint16).tobytes())
                cnt.append(np.minimum(c[at], 65535).astype(np.uint16).tobytes())
                lang.append(name)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array(idx, pa.binary()), pa.array(cnt, pa.binary()), pa.array(lang, pa.string())], ["key", "idx", "cnt", "lang"]
        )

    got = map_texts(sample(docs, id_col, text_col, lang_col, per_language), ["id", "text", "lang"], counted, "key string, idx binary, cnt binary, lang string")
    rows = sorted(got.toArrow().to_pylist(), key=lambda r: (r["lang"], r["key"]))
    if not rows:
        return Model([], np.zeros((0, DIMENSIONS), np.float32), np.ones(DIMENSIONS, np.float32), np.zeros(0))
    df = np.zeros(DIMENSIONS)
    for r in rows:
        df[np.frombuffer(r["idx"], np.uint16)] += 1
    idf = (np.log((1 + len(rows)) / (1 + df)) + 1).astype(np.float32)
    languages, centroids, floors = [], [], []
    for name, group in groupby(rows, key=lambda r: r["lang"]):
        own_rows = list(group)
        x = np.zeros((len(own_rows), DIMENSIONS), np.float32)
        for row, r in zip(x, own_rows, strict=True):
            at = np.frombuffer(r["idx"], np.uint16)
            row[at] = np.log1p(np.frombuffer(r["cnt"], np.uint16).astype(np.float32)) * idf[at]
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        c = cluster(x, clusters)
        near = x @ c.T
        own = near.argmax(1)
        for j in range(len(c)):
            mine = near[own == j, j]
            floors.append(float(np.quantile(mine, REJECT_QUANTILE)) - REJECT_MARGIN if len(mine) else 0.0)
            languages.append(name)
            centroids.append(c[j])
    return Model(languages, np.stack(centroids), idf, np.array(floors))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred, score (cosine, 0 to 1) and rejected; one narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS x CLUSTERS floats (128 KiB) for each language

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        names, scores, rejected = [], [], []
        for text in batch.column(1).to_pylist():
            if not text or not m.languages or not lettered(text):
                names.append("und")
                scores.append(0.0)
                rejected.append(True)
                continue
            near = m.centroids @ vector(text, m.idf)
            best = int(near.argmax())
            names.append(m.languages[best])
            scores.append(float(min(max(near[best], 0.0), 1.0)))
            rejected.append(bool(near[best] < m.floor[best]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], ["id", "lang_pred", "score", "rejected"]
        )

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col, text_col], run, f"id {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)
