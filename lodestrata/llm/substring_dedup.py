"""Substring dedup by recompression: remove word windows that an earlier document has.

A window is ``window`` consecutive words of one document; each word covered by
a window whose word sequence also starts in a document with a smaller id is
removed. Windows are judged on the input, not on what is left.

Every document is parsed by rounds of recompression (:mod:`.recompression`).
Names are global, so equal substrings share their interior symbols.

1. *Chunks.* The coarsest round cuts documents at some of the highest symbols,
   about every thirty words. A chunk, with the words that its last windows
   need, is one row (hash, id); the smallest id of each hash is aggregated with
   map-side combining. A chunk that a smaller id has is repeated as a whole, so
   long repeats end here, at a thirtieth of the windows.
2. *Symbols.* Each remaining window picks a top symbol that it wholly determines
   (or, without one, a run of two thirds of its words); equal windows pick
   equal symbols, about three for every ten words. Symbols that one document alone holds are dropped: no window there
   repeats. (The first document that has a window never has it in a repeated
   chunk, so leaving out repeated chunks loses nothing.)
3. *Windows.* Remaining windows under shared symbols are verified by the hash of
   their whole word sequence; the smallest id of each is aggregated, and what
   later documents have goes back to them.

Rows between the steps are hashes and ids. Words are hashed eight bytes at a
time by a mixing chain; what decides a removal (chunks and windows) has to agree
in two independent hashes of its words, of 64 and of 61 bits.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; null or empty texts have none.
Documents shorter than a window lose nothing. Rows that repeat an id are judged
alike, each on its own text; rows with a null id lose nothing and make no other
lose. Texts and words may be of any length; an empty table stays empty. Extra
columns are handed through by :func:`remove`, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, cut, join_counted, map_texts, quoted, unused
from .recompression import FieldHashes, anchors, cuts, interval_hashes, mixed, parse, prefix_hashes, word_hashes

WINDOW = 13
#: One in so many top symbols cuts.
ONE_IN = 4
#: Stands between documents of one batch; no symbol that depends on it is used.
SEPARATOR = np.uint64(0x5851F42D4C957F2D)
#: Bytes of texts parsed together (or one text).
BATCH_BYTES = 1 << 18

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """The words of some texts as one token array, with a separator after each text."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join([*texts, b"\n" * 8]), np.uint8)
        edge = np.diff(np.concatenate([[True], _BLANK[raw]]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        hashes = word_hashes(raw, self.start, self.end)
        last = np.searchsorted(self.start, np.cumsum([len(t) + 1 for t in texts]))  # words before each text's end
        self.sizes = np.diff(np.concatenate([[0], last]))
        self.first_word = last - self.sizes
        self.tokens = np.insert(hashes, last, SEPARATOR)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes + 1)[:-1]])
        self.owner = np.repeat(np.arange(len(texts)), self.sizes + 1)
        self.prefix = prefix_hashes(self.tokens)

    def windows(self, window: int) -> np.ndarray:
        """Places at which a window starts."""
        at = np.arange(max(0, len(self.tokens) - window + 1))
        return at[at + window <= (self.begin + self.sizes)[self.owner[at]]]

    def chunks(self, levels, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """Hash of each chunk, its document, the chunk number of each window, and the chunks' (start, end)."""
        new = np.zeros(len(self.tokens) + 1, bool)
        new[self.begin] = True
        new[cuts(levels, (self.begin + self.sizes)[self.owner], ONE_IN)] = True
        group = np.cumsum(new)[at]
        head = np.ones(len(at), bool)
        head[1:] = group[1:] != group[:-1]
        heads = np.flatnonzero(head)
        last = at[np.append(heads[1:], len(at)) - 1]
        names = mixed(interval_hashes(self.prefix, at[heads], last + window) ^ np.uint64(window))
        return names, self.owner[at[heads]], np.cumsum(head) - 1, (at[heads], last + window)


def batched(texts: list[bytes]):
    """Index ranges of at most ``BATCH_BYTES`` (or one text)."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > BATCH_BYTES:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def among(values: np.ndarray, docs: np.ndarray, lists: pa.Array, lo: int, n: int) -> np.ndarray:
    """Which values are in the list of their document (documents rise from 0 to n - 1)."""
    out = np.zeros(len(values), bool)
    ends = np.searchsorted(docs, np.arange(n + 1))
    for i in range(n):
        a, z = ends[i], ends[i + 1]
        held = lists[lo + i]
        if z > a and held.is_valid:
            out[a:z] = np.isin(values[a:z], held.values.to_numpy().view(np.uint64))
    return out


def utf8(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


class _Rows:
    """Distinct (hash, id) or (hash, second hash, id) rows of a batch."""

    def __init__(self):
        self.columns: list[tuple[np.ndarray, ...]] = []

    def add(self, docs: np.ndarray, *hashes: np.ndarray) -> None:
        order = np.lexsort((*hashes, docs))
        docs, *hashes = (x[order] for x in (docs, *hashes))
        new = np.ones(len(docs), bool)
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in (docs, *hashes)])
        self.columns.append(tuple(x[new] for x in (docs, *hashes)))

    def batch(self, ids: pa.Array, names: list[str]) -> pa.RecordBatch:
        empty = (np.empty(0, np.int64), *[np.empty(0, np.uint64)] * (len(names) - 1))
        docs, *hashes = (np.concatenate(x) for x in zip(empty, *self.columns, strict=True))
        return pa.RecordBatch.from_arrays([*[pa.array(h.view(np.int64)) for h in hashes], ids.take(pa.array(docs.astype(np.int64)))], names)


def repeats(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(id, chunks, windows): hashes of what is repeated in each document that repeats anything."""
    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")

    def scan(step: str, names: list[str]):
        """Hashes of the texts' chunks, or of symbols or windows outside of repeated chunks."""

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, out = utf8(batch.column(1)), _Rows()
            for lo, hi in batched(texts):
                w = Words(texts[lo:hi])
                at = w.windows(window)
                if not len(at):
                    continue
                levels = parse(w.tokens)
                chunk, owner, number, bounds = w.chunks(levels, at, window)
                if step == "chunks":
                    out.add(owner + lo, chunk, FieldHashes(w.tokens).of(*bounds))
                    continue
                fresh = at[~among(chunk, owner, batch.column(2), lo, hi - lo)[number]]
                symbol = anchors(levels, w.prefix, window)[fresh]
                if step == "symbols":
                    out.add(w.owner[fresh] + lo, symbol)
                    continue
                places = fresh[among(symbol, w.owner[fresh], batch.column(3), lo, hi - lo)]
                out.add(w.owner[places] + lo, interval_hashes(w.prefix, places, places + window), FieldHashes(w.tokens).of(places, places + window))
            return out.batch(batch.column(0), names)

        return run

    def stored(rows: DataFrame, columns: list[str], step: str, *hashes: str) -> Stored:
        schema = "".join(f"{h} long, " for h in hashes) + f"id {kind}"
        return Stored(map_texts(rows, columns, scan(step, [*hashes, "id"]), schema, 256))

    def later(rows: DataFrame, name: str) -> DataFrame:
        """(id, list of the values that a smaller id has)."""
        first = cut(rows.groupBy("v", "w").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("c")).where("lo < hi").select("v", "w", "lo", "c"))
        return cut(join_counted(rows, first, ["v", "w"]).where("id > lo").groupBy("id").agg(F.collect_set("v").alias(name)))

    with stored(named, ["id", "text"], "chunks", "v", "w") as rows:
        chunks = later(rows, "chunks")
    with stored(named.join(chunks, "id", "left"), ["id", "text", "chunks"], "symbols", "v") as rows:
        shared = cut(rows.groupBy("v").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("c")).where("lo < hi").select("v", "c"))
        symbols = cut(join_counted(rows, shared, ["v"]).groupBy("id").agg(F.collect_set("v").alias("symbols")))  # at most one per word
    with stored(named.join(symbols, "id").join(chunks, "id", "left"), ["id", "text", "chunks", "symbols"], "windows", "v", "w") as rows:
        windows = later(rows, "windows")
    return chunks.join(windows, "id", "full")


def covered(words: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of the words lie in a window that starts at one of ``starts``."""
    step = np.zeros(words + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    return np.cumsum(step)[:words] > 0


class Cut:
    """The texts of one batch with their repeated words found."""

    def __init__(self, texts: list[bytes], chunks: pa.Array, windows: pa.Array, window: int):
        self.texts = texts
        self.n: list[int] = []
        self.gone: list[np.ndarray | None] = []
        self.bounds: list[tuple[np.ndarray, np.ndarray]] = []
        for lo, hi in batched(texts):
            w = Words(texts[lo:hi])
            at = w.windows(window)
            hit = np.zeros(len(at), bool)
            if len(at) and any(chunks[i].is_valid or windows[i].is_valid for i in range(lo, hi)):
                chunk, owner, number, _ = w.chunks(parse(w.tokens), at, window)
                hit = among(chunk, owner, chunks, lo, hi - lo)[number]
                hit |= among(interval_hashes(w.prefix, at, at + window), w.owner[at], windows, lo, hi - lo)
            at = at[hit]
            ends = np.searchsorted(w.owner[at], np.arange(hi - lo + 1))
            offset = np.cumsum([0, *[len(t) + 1 for t in texts[lo:hi]]])
            for i in range(hi - lo):
                a, z = w.first_word[i], w.first_word[i] + w.sizes[i]
                starts = at[ends[i] : ends[i + 1]] - w.begin[i]
                self.n.append(int(w.sizes[i]))
                self.bounds.append((w.start[a:z] - offset[i], w.end[a:z] - offset[i]))
                self.gone.append(covered(int(w.sizes[i]), starts, window) if len(starts) else None)

    def kept(self, i: int) -> bytes:
        """The words of text ``i`` that stay, joined by one space."""
        text, gone = self.texts[i], self.gone[i]
        if gone is None:
            return b" ".join(text.split())
        start, end = (x[~gone].tolist() for x in self.bounds[i])
        return b" ".join([text[a:z] for a, z in zip(start, end, strict=True)])


def _with_repeats(docs: DataFrame, window: int, id_col: str, text_col: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with the lists of repeated chunks and windows, and the names of these two columns."""
    key, *lists = unused(docs.columns, "_sd_id", "_sd_chunks", "_sd_windows")
    found = repeats(docs, window, id_col, text_col).withColumnsRenamed({"id": key, "chunks": lists[0], "windows": lists[1]})
    return docs.join(found, F.col(quoted([id_col])[0]) == F.col(key), "left").drop(key), lists


def digests(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_words, n_removed and the digest of the kept words of every document."""
    joined, lists = _with_repeats(docs.select(id_col, text_col), window, id_col, text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = Cut(utf8(batch.column(1)), batch.column(2), batch.column(3), window)
        gone = [0 if g is None else int(g.sum()) for g in c.gone]
        sha = [hashlib.sha256(c.kept(i)).hexdigest() for i in range(batch.num_rows)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(c.n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], ["id", "n_words", "n_removed", "kept_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(joined, [id_col, text_col, *lists], run, f"id {kind}, n_words long, n_removed long, kept_sha256 string", 256).withColumnRenamed("id", id_col)


def remove(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated windows cut out of the text.

    A text that loses words becomes its kept words joined by one space; any
    other text stays as it is, white space included.
    """
    joined, lists = _with_repeats(docs, window, id_col, text_col)
    names = docs.columns
    place = names.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = Cut(utf8(batch.column(place)), batch.column(len(names)), batch.column(len(names) + 1), window)
        texts = [t if g is None else c.kept(i).decode() for i, (t, g) in enumerate(zip(batch.column(place).to_pylist(), c.gone, strict=True))]
        out = [batch.column(i) for i in range(len(names))]
        out[place] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(out, names)

    return map_texts(joined, quoted([*names, *lists]), run, docs.schema, 256)
