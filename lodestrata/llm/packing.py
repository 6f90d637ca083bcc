"""Best-fit packing of documents into fixed-length sequences by length patterns.

1. Documents are encoded and cut into pieces of at most ``capacity`` tokens.
2. The histogram of piece lengths (at most ``capacity`` bins, whatever the
   corpus) goes to the driver. Patterns of two to four lengths that fill a
   sequence are enumerated and non-negative least squares fits their repeat
   counts to the histogram; counts are rounded down. What is left is packed
   largest first by best fitting patterns, with repeat counts, so this too costs by bins.
3. The plan says which ranks of each length go to which sequences at which
   offset. Pieces are ranked within their length by counts over salted groups,
   so that a length which a third of all pieces share is never in one task.

Defined results: a null text is empty; an empty text is one piece that holds
the end token alone. Repeated rows are packed each (ties between equal keys are
interchangeable); extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import cut, shuffle_width, slices_of

CAPACITY = 2048
#: Patterns that the least-squares fit chooses from, at most.
MAX_PATTERNS = 20_000
#: Sweeps of coordinate descent.
SWEEPS = 60

PIECES = "doc_id {kind}, piece int, start long, length long, ids_crc32 long"


def encode_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: place, length and checksum of its ids; a narrow pass."""
    spec = bpe.ship(docs.sparkSession, vocabulary)

    def run(batches):
        enc = bpe.encoder(spec.value)
        end, step = int(end_id).to_bytes(4, "little"), 4 * capacity
        for part in slices_of(batches, 1, bpe.TEXT_BYTES):
            row, piece, start, length, crc = [], [], [], [], []
            flat, ends = enc.encode_many([t or "" for t in part.column(1).to_pylist()])
            body, ends = flat.tobytes(), (4 * ends).tolist()
            for i, (a, z) in enumerate(zip([0, *ends], ends, strict=False)):
                ids = body[a:z] + end
                for k, at in enumerate(range(0, len(ids), step)):
                    chunk = ids[at : at + step]
                    row.append(i)
                    piece.append(k)
                    start.append(at >> 2)
                    length.append(len(chunk) >> 2)
                    crc.append(zlib.crc32(chunk))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, PIECES.format(kind=docs.schema[id_col].dataType.simpleString()))


def patterns(h: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Patterns of two to four present lengths that fill a sequence, or nearly.

    Each present length is combined with each partner; what then remains is
    filled by the most frequent exact fit or a split in two. ``h[l]`` counts
    the pieces of length ``l``.
    """
    present = np.flatnonzero(h)
    present = present[(present > 0) & (present < capacity)]
    if not len(present):
        return []
    # best[r]: the largest present length up to r
    best = np.zeros(capacity + 1, int)
    best[present] = present
    best = np.maximum.accumulate(best)
    found: dict[tuple[int, ...], float] = {}
    for a in present[::-1]:
        room = capacity - int(a)
        partners = present[present <= min(room, int(a))]
        if len(partners) > 64:  # the most frequent, and an even spread of the others
            top = partners[np.argsort(-h[partners], kind="stable")[:32]]
            partners = np.unique(np.concatenate([top, partners[:: max(1, len(partners) // 32)], [best[room]]]))
        for b in partners:
            rest = room - int(b)
            c = int(best[rest]) if rest else 0
            c = min(c, int(b)) if h[min(c, int(b))] else int(best[min(rest, int(b))])
            d = int(best[min(rest - c, c)]) if c and rest > c else 0
            p = tuple(x for x in (int(a), int(b), c, d) if x)
            found[p] = max(found.get(p, 0.0), capacity - sum(p))
    order = sorted(found, key=lambda p: (found[p], p))
    return order[:MAX_PATTERNS]


def fit_counts(h: np.ndarray, pats: list[tuple[int, ...]], sweeps: int = SWEEPS) -> np.ndarray:
    """Non-negative least squares by projected gradients with momentum: repeat counts x >= 0 of ``pats``."""
    if not pats:
        return np.zeros(0)
    owner = np.repeat(np.arange(len(pats)), [len(p) for p in pats])
    bins = np.concatenate([np.array(p) for p in pats])
    x = np.zeros(len(pats))
    # the largest row sum of |A|'|A| bounds the curvature; rows are scaled by their own
    per_bin = np.bincount(bins, minlength=len(h)).astype(float)
    curve = np.maximum(np.bincount(owner, per_bin[bins], len(pats)), 1.0)
    y, t = x.copy(), 1.0
    for _ in range(sweeps * 5):
        miss = h - np.bincount(bins, y[owner], len(h))
        new = np.maximum(y + np.bincount(owner, miss[bins], len(pats)) / curve, 0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def plan(h: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) for all pieces counted in ``h``; full pieces alone."""
    left = h.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        out.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    pats = patterns(left, capacity)
    x = fit_counts(left.astype(float), pats)
    for i in np.argsort(-x, kind="stable"):
        n = int(np.floor(x[i] + 1e-9))
        if n < 1 or sum(pats[i]) < capacity * 0.998:
            continue
        sizes, many = np.unique(np.array(pats[i]), return_counts=True)
        n = min(n, int((left[sizes] // many).min()))
        if n:
            left[sizes] -= n * many
            out.append((pats[i], n))
    # residuals: largest first; the pattern that best fills the room repeats while its lengths last
    while (present := np.flatnonzero(left)).size:
        first = int(present[-1])
        p, room = [first], capacity - first
        left[first] -= 1
        while room:
            fit = fill(left, room)
            if not fit:
                break
            for b in fit:
                left[b] -= 1
            p += fit
            room -= sum(fit)
        sizes, many = np.unique(np.array(p), return_counts=True)
        n = 1 + int((left[sizes] // many).min())
        left[sizes] -= (n - 1) * many
        out.append((tuple(p), n))
    return out


def fill(left: np.ndarray, room: int) -> list[int]:
    """One or two lengths left that best fill ``room`` (the larger one first), or none."""
    present = np.flatnonzero(left[: room + 1])
    if not len(present):
        return []
    top = int(present[-1])
    if top == room:
        return [top]
    # two lengths: for each a, the largest b <= room - a
    a = present[::-1][:256]
    b = np.searchsorted(present, room - a, "right") - 1
    ok = b >= 0
    a, b = a[ok], present[np.maximum(b[ok], 0)]
    b = np.where((a == b) & (left[a] < 2), 0, b)
    total = np.where(b > 0, a + b, 0)
    if len(total) and total.max() > top:
        k = int(total.argmax())
        return sorted((int(a[k]), int(b[k])), reverse=True)
    return [top]


def slots(planned: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, past rank, first sequence, offset), by length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in planned:
        offset = 0
        for length in pattern:
            r = used.get(length, 0)
            rows.append((length, r, r + n, sequence, offset))
            used[length] = r + n
            offset += length
        sequence += n
    rows.sort()
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def ranked(pieces: DataFrame) -> DataFrame:
    """Pieces with their rank (from 0) within their length.

    Salted by a hash of the key into as many groups as there are shuffle
    partitions: a piece's rank is its place in its group plus the sizes of the
    earlier groups of its length (a table of length x salt counts).
    """
    width = shuffle_width(pieces.sparkSession)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(width)).cast("int"))
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    return salted.withColumn("_r", F.row_number().over(own) - 1).join(base, ["length", "_salt"]).withColumn("rank", F.col("_r") + F.col("_base")).drop("_r", "_base", "_salt")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece a sequence and an offset; ``pieces`` must be cheap to read twice."""
    rows = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    h = np.zeros(capacity + 1, np.int64)
    for r in rows:
        h[r["length"]] = r["n"]
    table = slots(plan(h, capacity))
    shared = pieces.sparkSession.sparkContext.broadcast(table)  # bounded by lengths and patterns
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def place(batches):
        t = shared.value
        keys = t[:, 0] << 44 | t[:, 1]
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            at = np.searchsorted(keys, length << 44 | rank, "right") - 1
            sequence = t[at, 3] + rank - t[at, 1]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(5)], pa.array(sequence), pa.array(t[at, 4])], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    return ranked(pieces).select(*columns).mapInArrow(place, PIECES.format(kind=kind) + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, cut and pack; encoded pieces are kept in the shared checkpoint folder."""
    pieces = encode_pieces(docs, vocabulary, capacity, end_id, id_col, text_col)
    return pack(cut(pieces), capacity).withColumnRenamed("doc_id", id_col)
