"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. Lexicons are mined from a bounded sample of labelled texts: words and word
   beginnings (stems) that toxic texts hold far more often than others, listed by
   their length and by how sure they are.
2. Every list and several patterns vote on a text: 1 (toxic), -1 (not), 0 (abstain).
3. The label model is a latent class model: a text's unknown class gives each
   voter's vote with that voter's own table of probabilities (its accuracy).
   Expectation maximisation fits the tables to the votes alone, without labels.
   Voters that agree beyond what the class explains are correlated; each voter's
   log odds are divided by one plus its correlations with the others, which are
   estimated anew in every round, so that ten forms of one hint count as one.
4. A linear classifier over hashed words and stems is fitted to the posterior
   probabilities. It scores every whole text in one narrow pass.

Defined results: a null or empty text, or one without a letter, has the score of
the bias alone (0 without a model). Without labels, or without toxic ones, there is
no model and every score is 0. Null labels are ignored; of several labels of an id
the greatest counts, on one of its texts (the smallest). Every row is scored on its
own whole text, so repeated rows get equal results. Columns other than id and text
are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, held, map_texts

#: The model is fitted on at most so many labelled texts (in hash order of the id).
SAMPLE_ROWS = 8000
#: Code points of the word beginnings that are looked at; 0 stands for the whole word.
STEMS = (0, 3, 4, 5, 6, 7)
#: A unit is listed when it is in so many toxic texts, and so many deviations more often than by chance.
LEAST_TEXTS, DEVIATIONS = 3, 5.5
#: Lists of units of which at least this share of texts is toxic are kept apart.
SURE = 0.9
#: A list votes for toxic when at least this share of the words is on it, against it below the second.
DENSE, SPARSE = 1 / 200, 1 / 800
#: Rounds of the label model and of the classifier.
ROUNDS, STEPS = 40, 300
#: Units that the classifier weighs, at most; the share of words at which a unit counts fully.
FEATURES, FULL = 2048, 1 / 60
#: Deviations from chance that a weighed unit shows at least.
FAR = 4
#: Ridge of the classifier.
RIDGE = 0.02
#: Texts with at least this score are toxic.
TOXIC = 0.7
#: Words whose units a worker remembers.
CACHE_WORDS = 200_000

#: ASCII bytes that are no letters count as spaces.
_SPACED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_MARKS = re.compile(r"([^\w\s])\1\1")


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode(errors="replace").translate(_SPACED).split() if text else []


def units_of(word: bytes) -> list[int]:
    """Numbers of a word and of its beginnings; the high bits tell which."""
    s = word.decode()
    return [zlib.crc32(word)] + [k << 32 | zlib.crc32(s[:k].encode()) for k in STEMS[1:] if len(s) > k]


class _Held(dict):
    """What ``of`` makes of a word, remembered while few."""

    def __init__(self, of):
        self.of = of

    def __missing__(self, word: bytes):
        got = self.of(word)
        if len(word) <= 64:
            if len(self) > CACHE_WORDS:
                self.clear()
            self[word] = got
        return got


# --- lexicons and votes -------------------------------------------------------------------------------


@dataclass
class Lexicons:
    """Unit -> number of the list that it is on."""

    lists: dict[int, int]

    @staticmethod
    def names() -> list[str]:
        each = ["words" if not k else f"stems of {k}" for k in STEMS]
        return [f"sure {n}" for n in each] + [f"likely {n}" for n in each]

    def of_word(self, word: bytes) -> tuple[int, ...]:
        return tuple(sorted({self.lists[u] for u in units_of(word) if u in self.lists}))


#: Patterns that vote besides the lists.
PATTERNS = ("several words", "many lines", "at the start", "no word", "exclamations", "repeated marks")


def mine(units: list[np.ndarray], toxic: np.ndarray) -> Lexicons:
    """Lists of the units that are far more frequent in toxic texts (units: those of each text, distinct)."""
    flat = np.concatenate(units) if units else np.zeros(0, np.int64)
    names, inverse = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(units)), [len(u) for u in units])
    n = np.bincount(inverse, minlength=len(names)).astype(float)
    bad = np.bincount(inverse, toxic[owner], minlength=len(names))
    share = min(max(float(toxic.mean()), 1e-6), 1 - 1e-6) if len(toxic) else 0.5
    deviation = (bad - n * share) / np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
    listed = np.flatnonzero((bad >= LEAST_TEXTS) & (deviation >= DEVIATIONS) & (bad > n * min(0.5, 3 * share)))
    sure = bad[listed] >= SURE * n[listed]
    kinds = [STEMS.index(int(names[i]) >> 32) for i in listed]
    return Lexicons({int(names[i]): k if s else k + len(STEMS) for i, k, s in zip(listed, kinds, sure, strict=True)})


def votes(text: str | None, memo: _Held) -> list[int]:
    """Votes of all lists and patterns (memo: lists of a word)."""
    words = words_of(text)
    n = len(words)
    out = [0] * (2 * len(STEMS) + len(PATTERNS))
    lists = 2 * len(STEMS)
    hits = {w: times for w, times in Counter(words).items() if memo[w]}
    count = [0] * lists
    for w, times in hits.items():
        for k in memo[w]:
            count[k] += times
    for k, c in enumerate(count):
        if c:
            out[k] = 1 if c >= DENSE * n else -1 if c < SPARSE * n else 0
    if hits:
        lines = [line for line in text.split("\n") if line.strip()]
        held_lines = sum(not hits.keys().isdisjoint(words_of(line)) for line in lines)
        out[lists] = int(len(hits) >= 2)
        out[lists + 1] = int(4 * held_lines >= len(lines))
        out[lists + 2] = int(not hits.keys().isdisjoint(words[:40]))
        out[lists + 3] = 0
    else:
        out[lists : lists + 4] = [-1] * 4
    if n:
        out[lists + 4] = int(40 * text.count("!") >= n)
        out[lists + 5] = int(bool(_MARKS.search(text)))
    return out


# --- label model ----------------------------------------------------------------------------------------


@dataclass
class LabelModel:
    """Share of toxic texts; for each voter P(vote | class), correlations given the class, and the weight of its log odds."""

    prior: float
    tables: np.ndarray  # (voters, 2 classes, 3 votes)
    correlations: np.ndarray  # (voters, voters)
    weights: np.ndarray  # (voters,)

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """P(toxic | votes) of each row."""
        odds = np.log(self.tables[:, 1]) - np.log(self.tables[:, 0])
        each = odds[np.arange(v.shape[1]), v + 1] * self.weights
        z = math.log(self.prior / (1 - self.prior)) + each.sum(1)
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))

    def accuracies(self) -> np.ndarray:
        """How often each voter is right when it votes."""
        right = self.prior * self.tables[:, 1, 2] + (1 - self.prior) * self.tables[:, 0, 0]
        wrong = self.prior * self.tables[:, 1, 0] + (1 - self.prior) * self.tables[:, 0, 2]
        return right / (right + wrong)


def fit_labels(v: np.ndarray, prior: float, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over the votes (rows, voters) in -1, 0, 1; the class is never seen."""
    prior = min(max(prior, 0.005), 0.995)
    rows, m = v.shape
    hot = np.stack([v == c for c in (-1, 0, 1)], 2).astype(float)  # rows, voters, votes
    # the start: the texts with the most votes for toxic, as many as the prior says
    total = v.sum(1)
    edge = np.quantile(total, 1 - prior) if rows else 0
    q = np.where((total >= edge) & (total > np.median(total)), 0.9, 0.02)
    model = None
    for _ in range(rounds):
        both = np.stack([1 - q, q], 1)  # rows, classes
        seen = np.einsum("rc,rmv->mcv", both, hot) + 0.5
        tables = seen / seen.sum(2, keepdims=True)
        mean = tables[:, :, 2] - tables[:, :, 0]  # voters, classes
        spread = np.zeros((m, m))
        for c in (0, 1):
            rest = v - mean[:, c]
            spread += (rest * both[:, c : c + 1]).T @ rest
        size = np.sqrt(np.maximum(np.diag(spread), 1e-12))
        correlations = np.clip(spread / np.outer(size, size), -1, 1)
        np.fill_diagonal(correlations, 1.0)
        weights = 1 / np.maximum(1.0, np.abs(correlations).sum(1))
        model = LabelModel(prior, tables, correlations, weights)
        q = model.posterior(v)
    return model


# --- classifier ------------------------------------------------------------------------------------------


@dataclass
class Model:
    bias: float
    weights: dict[int, float]  # by unit
    lexicons: Lexicons = field(default_factory=lambda: Lexicons({}))
    labels: LabelModel | None = None


def _strength(count, n: int):
    """How much a unit counts that is ``count`` times among n words."""
    return np.sqrt(np.minimum(1.0, count / (FULL * max(n, 1))))


def fit_linear(rows: list[np.ndarray], values: list[np.ndarray], target: np.ndarray, steps: int = STEPS, ridge: float = RIDGE) -> tuple[dict[int, float], float]:
    """Weights by unit, and bias, of a logistic regression on soft targets (Adam, ridge)."""
    flat, x = np.concatenate(rows), np.concatenate(values)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    names, at = np.unique(flat, return_inverse=True)
    n = np.bincount(at, minlength=len(names))
    share = float(target.mean())
    far = np.abs(np.bincount(at, target[owner], minlength=len(names)) - n * share) / np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
    far[n < 2] = 0
    kept = np.sort(np.lexsort((names, -far))[:FEATURES])
    kept = kept[far[kept] > FAR]
    place = np.full(len(names), -1)
    place[kept] = np.arange(len(kept))
    some = place[at] >= 0
    at, x, owner = place[at][some], x[some], owner[some]
    p = np.zeros(len(kept) + 1)
    p[-1] = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
    m, s = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        z = np.bincount(owner, p[at] * x, len(rows)) + p[-1]
        miss = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - target
        g = np.append(np.bincount(at, miss[owner] * x, len(kept)) + ridge * p[:-1], miss.sum()) / len(rows)
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        p -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-9)
    return {int(u): float(w) for u, w in zip(names[kept], p[:-1], strict=True) if abs(w) > 1e-3}, float(p[-1])


def unit_counts(words: list[bytes], memo: _Held) -> dict[int, int]:
    """How often each unit is among the words (memo: units of a word that matter)."""
    out: dict[int, int] = {}
    for w, times in Counter(words).items():
        for u in memo[w]:
            out[u] = out.get(u, 0) + times
    return out


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """(id, text, toxic) of at most ``rows`` labelled texts, stored: they are read twice."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    # an id may repeat without bound: one text of each
    one = texts.join(F.broadcast(chosen.select("id")), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    return cut(one.join(F.broadcast(chosen), "id"))


def _repeated(got: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Units of each text and how much they count, without units of one text alone, which are most and decide nothing."""
    rows = [np.frombuffer(u, np.int64) for u in got.column("units").to_pylist()]
    names, n = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.int64), return_counts=True)
    often = names[n > 1]
    units, values = [], []
    for u, counts, size in zip(rows, got.column("counts").to_pylist(), got.column("n").to_pylist(), strict=True):
        at = np.searchsorted(often, u)
        kept = np.flatnonzero(at < len(often))
        kept = kept[often[at[kept]] == u[kept]]
        units.append(u[kept])
        values.append(_strength(np.frombuffer(counts, np.uint32)[kept], size))
    return units, values


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Lexicons, label model and classifier from the labelled texts; only their hashed units and votes reach the driver."""
    sample = _sample(docs, labels, id_col, text_col, label_col, sample_rows)

    def described(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo, ids, values, sizes = _Held(units_of), [], [], []
        for text in batch.column(1).to_pylist():
            words = words_of(text)
            counts = unit_counts(words, memo)
            order = sorted(counts)
            ids.append(np.array(order, np.int64).tobytes())
            values.append(np.array([counts[u] for u in order], np.uint32).tobytes())
            sizes.append(len(words))
        return pa.RecordBatch.from_arrays(
            [pa.array(map(str, batch.column(0).to_pylist()), pa.string()), pa.array(ids, pa.binary()), pa.array(values, pa.binary()), pa.array(sizes, pa.int64()), batch.column(2)],
            ["key", "units", "counts", "n", "toxic"],
        )

    got = map_texts(sample, ["id", "text", "toxic"], described, "key string, units binary, counts binary, n long, toxic int").toArrow().sort_by("key")
    toxic = (got.column("toxic").to_numpy() > 0).astype(float)
    units, values = _repeated(got)
    del got
    if not toxic.any():
        return Model(-35.0, {})
    lexicons = mine(units, toxic)
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)  # bounded by the sample

    def voted(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo = _Held(shared.value.of_word)
        found = [np.array(votes(t, memo), np.int8).tobytes() for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(map(str, batch.column(0).to_pylist()), pa.string()), pa.array(found, pa.binary())], ["key", "votes"])

    ballots = map_texts(sample, ["id", "text"], voted, "key string, votes binary").toArrow().sort_by("key").column("votes").to_pylist()
    v = np.stack([np.frombuffer(b, np.int8) for b in ballots]).astype(int)
    model = fit_labels(v, float(toxic.mean()))
    weights, bias = fit_linear(units, values, model.posterior(v))
    return Model(bias, weights, lexicons, model)


def judge(model: Model, memo: _Held, text: str | None) -> float:
    """A text's score (memo: the units of a word that have a weight)."""
    words = words_of(text)
    z = model.bias
    if words:
        counts = unit_counts(words, memo)
        z += sum(model.weights[u] * float(_strength(c, len(words))) for u, c in sorted(counts.items()))
    return 1 / (1 + math.exp(-min(max(z, -35.0), 35.0))) if model.weights or model.labels else 0.0


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", toxic: float = TOXIC) -> DataFrame:
    """``id_col``, score and predicted of every row; one narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by FEATURES and the sample
    name = f"toxicity {uuid.uuid4().hex}"

    def weighed() -> _Held:
        known = shared.value.weights
        return _Held(lambda word: tuple(u for u in units_of(word) if u in known))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo = held(name, weighed)
        found = [judge(shared.value, memo, t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64()), pa.array([int(x >= toxic) for x in found], pa.int32())], ["id", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_texts(rows, ["id", "text"], run, f"id {docs.schema[id_col].dataType.simpleString()}, score double, predicted int", 256, name).withColumnRenamed("id", id_col)
