"""MinHash near-duplicates by a multi-index Hamming join, confirmed on full sets.

1. A document's set holds the hashes of its distinct word shingles (A-Z are
   lower-cased). Documents with equal sets form a class, represented by its
   smallest id; only representatives go on, so groups of copies cost nothing.
2. A set's signature has ``COMPONENTS`` components of b = 16 bits. It is split
   into ``CHUNKS`` chunks. By the pigeonhole principle two signatures within
   ``DISTANCE`` components of one another have a chunk with at most
   ``DISTANCE // CHUNKS`` errors; all wildcards for that many errors are
   enumerated as keys, so every such pair shares a key.
3. The representatives under one key are compared with one another on their
   full sets: each set is sent to the key's tile (or tiles, when a key has so many
   members that it is split into blocks), where exact intersections come from a
   product of membership matrices. A tile returns a spanning forest of its
   links, never all pairs. Keys with equal members are compared once.
4. Components of the links give each document its group.

Defined results: a text with fewer words than a shingle has its whole word
sequence as its only shingle; without a word (or null) the set is empty and linked with
nothing. Rows with equal ids count as one document each time they occur; rows
with a null id are linked with nothing and kept.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import cut, held, map_texts

SHINGLE = 5
#: Components of a signature, of 16 bits each.
COMPONENTS = 36
#: Chunks that a signature is split into.
CHUNKS = 9
#: All pairs whose signatures differ in at most so many components are compared.
#: At a similarity of 0.8, a pair misses every key with a probability below 1e-6.
DISTANCE = 17
#: Members of a key's block, and bytes of their sets.
BLOCK_ROWS, BLOCK_BYTES = 1024, 48 << 20
#: Ids of documents to compare are broadcast up to so many (8 bytes each).
BROADCAST_IDS = 500_000

_RNG = np.random.default_rng(20240501)
_MULT = _RNG.integers(1, 1 << 63, COMPONENTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, COMPONENTS, dtype=np.uint64) * np.uint64(2)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(SHINGLE)], dtype=np.uint64)
#: Words whose hash a worker remembers (some 30 MB).
CACHE_WORDS = 200_000
#: Name under which a worker keeps them.
MEMO = "minhash words"


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (finaliser of the SplitMix generator)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHash(dict):
    """64-bit hashes of words, remembered while few."""

    def __missing__(self, word: bytes) -> int:
        got = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            if len(self) > CACHE_WORDS:
                self.clear()
            self[word] = got
        return got


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: ASCII case and the six ASCII white spaces


def shingles(text: bytes | None, memo: WordHash) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    found = words_of(text) if text else []
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
    n = max(1, len(w) - SHINGLE + 1)
    h = np.full(n, min(len(w), SHINGLE), np.uint64)
    for k in range(min(len(w), SHINGLE)):
        h += w[k : k + n] * _POWERS[k]
    return np.unique(mixed(h))


def signature(s: np.ndarray) -> np.ndarray:
    """16 bits of the least hash of the set under each of ``COMPONENTS`` permutations."""
    out = np.empty(COMPONENTS, np.uint64)
    for i in range(COMPONENTS):
        out[i] = (s * _MULT[i] + _ADD[i]).min()
    return (mixed(out) & np.uint64(0xFFFF)).astype(np.uint16)


def chunk_keys(sig: np.ndarray, chunks: int = CHUNKS, distance: int = DISTANCE) -> np.ndarray:
    """Keys of each signature (rows): every chunk under every choice of allowed errors."""
    width = sig.shape[1] // chunks
    errors = distance // chunks
    values = sig.astype(np.uint64)
    out = []
    for c in range(chunks):
        for n, gone in enumerate(combinations(range(width), errors)):
            h = np.full(len(sig), c << 20 | n, np.uint64)
            for j in range(width):
                if j not in gone:
                    h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + values[:, c * width + j] + np.uint64(1))
            out.append(h)
    return np.stack(out, 1).view(np.int64)


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, fp, keys): set size, 128-bit fingerprint of the set, chunk keys."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo = _memo()
        n, fps, sigs = [], [], []
        for text in batch.column(1).cast(pa.binary()).to_pylist():
            s = shingles(text, memo)
            n.append(len(s))
            fps.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            sigs.append(signature(s) if len(s) else np.zeros(COMPONENTS, np.uint16))
        keys = chunk_keys(np.stack(sigs)) if sigs else np.zeros((0, 1), np.int64)
        size = keys.shape[1]
        offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32) * size)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(fps, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))],
            ["id", "n_shingles", "fp", "keys"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col, text_col], run, f"id {kind}, n_shingles long, fp binary, keys array<long>", keep=MEMO)


def _memo() -> WordHash:
    return held(MEMO, WordHash)


def tiles_of(classes: DataFrame) -> DataFrame:
    """(rep, tiles): where each representative's set has to go; keys with one member go nowhere."""
    keys = classes.where("n_shingles > 0").select("rep", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(7))).alias("y"), F.sum(8 * F.col("n")).alias("bytes")).where("members > 1")
    # keys with the same members are compared once
    once = shared.groupBy("members", "x", "y", "bytes").agg(F.min("key").alias("tile"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    once = once.select("tile", blocks.alias("blocks"))
    placed = keys.join(once, F.col("key") == F.col("tile")).withColumn("b", F.pmod(F.xxhash64("rep", "tile"), F.col("blocks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct("tile", F.least("b", j).alias("i"), F.greatest("b", j).alias("j")))
    return placed.groupBy("rep").agg(F.flatten(F.collect_list(others)).alias("tiles"))  # at most keys x blocks each


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def forest(ids: list[int], sets: list[np.ndarray], percent: int, left: list[bool] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets."""
    n = len(ids)
    if n == 2:
        return [(ids[0], ids[1])] if linked(sets[0], sets[1], percent) else []
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    _, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    shared = count[inverse] > 1  # a shingle of one set alone is in no intersection
    column, owner = (np.cumsum(count > 1) - 1)[inverse[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((n, n), np.float32)
    step = max(64, (8 << 20) // (4 * n))
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, z = np.searchsorted(column, [lo, lo + step])
        m = np.zeros((n, step), np.float32)
        m[owner[a:z], column[a:z] - lo] = 1
        common += m @ m.T
    union = sizes[:, None] + sizes[None, :] - common
    good = 100 * common.astype(np.float64) >= percent * union.astype(np.float64)
    out, unseen = [], np.ones(n, bool)
    for root in range(n):  # breadth first
        if not unseen[root]:
            continue
        unseen[root] = False
        stack = [root]
        while stack:
            u = stack.pop()
            new = np.flatnonzero(good[u] & unseen)
            unseen[new] = False
            stack += new.tolist()
            out += [(ids[u], ids[v]) for v in new.tolist()]
    return out


def links(docs: DataFrame, classes: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(a, b): verified links between representatives that connect all that are linked."""
    todo = cut(tiles_of(classes))
    texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text"))
    if todo.count() <= BROADCAST_IDS:
        texts = texts.join(F.broadcast(todo.select("rep")), "rep", "left_semi")  # texts that nobody asks for stay unread by the shuffle
    asked = texts.join(todo, "rep")
    kind = docs.schema[id_col].dataType.simpleString()

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo, rows = _memo(), {k: [] for k in ("tile", "i", "j", "rep", "set")}
        for rep, text, places in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
            body = shingles(text, memo).tobytes()
            for p in places:
                for k in ("tile", "i", "j"):
                    rows[k].append(p[k])
                rows["rep"].append(rep)
                rows["set"].append(body)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["tile"], pa.int64()), pa.array(rows["i"], pa.int32()), pa.array(rows["j"], pa.int32()), pa.array(rows["rep"], batch.column(0).type), pa.array(rows["set"], pa.binary())],
            ["tile", "i", "j", "rep", "set"],
        )

    sent = map_texts(asked, ["rep", "text", "tiles"], spread, f"tile long, i int, j int, rep {kind}, set binary", 32, MEMO)
    grouped = sent.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j", "rep")

    def compare(batches):
        key, ids, sets = None, [], []

        def flush():
            return forest(ids, sets, percent) if len(ids) > 1 else []

        for b in batches:
            found = []
            for t, i, j, rep, body in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
                if (t, i, j) != key:
                    found += flush()
                    key, ids, sets = (t, i, j), [], []
                if not ids or ids[-1] != rep:  # a repeated id is compared once
                    ids.append(rep)
                    sets.append(np.frombuffer(body, np.uint64))
            yield edges(found, b.column(3).type)
            last = b.column(3).type
        if key is not None:
            yield edges(flush(), last)

    def edges(found, kind_):
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], kind_), pa.array([y for _, y in found], kind_)], ["a", "b"])

    return grouped.mapInArrow(compare, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept): component_id is the smallest id reachable."""
    rows = cut(described(docs, id_col, text_col))
    filled = rows.where("n_shingles > 0 and id is not null")
    classes = cut(filled.groupBy("fp").agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")))
    found = connected_components(cut(links(docs, classes, percent, id_col, text_col)))
    groups = classes.select("fp", "rep").join(found, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    named = filled.select("id", "n_shingles", "fp").join(groups, "fp").select("id", "n_shingles", "component_id")
    empty = rows.where("n_shingles = 0 or id is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    return named.unionByName(empty).select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
