"""Suffix-array dedup: remove bytes of long strings that occur earlier in the corpus.

Texts are UTF-8 bytes; a match never crosses documents. A byte is removed when
a ``length``-byte string that covers it also starts earlier: in a document with
a smaller id, or in the same one at an earlier place. Overlaps count, and
strings are judged on the input.

1. Chunks. Texts are cut where the hash of a ``GRAM``-byte piece says so, about
   every ``ONE_IN`` bytes. Of equal chunks (each with the bytes that its last
   strings need) all but the earliest are repeated as a whole; long copies end
   here. The earliest place of a string is never in such a chunk.
2. Sharding. Every remaining string of ``length`` bytes picks an anchor, the
   smallest hash of its pieces (leftmost of equals); equal strings pick equal
   anchors. Strings whose anchor occurs once cannot repeat and end here.
   Consecutive strings with one anchor form a fragment; of equal fragments all
   but the earliest are repeated as a whole.
3. Different fragments of an anchor meet in one shard. The shard's suffix array is
   built in memory by induced sorting (:mod:`.induced_sort`); neighbours that
   begin with the same ``length`` bytes are occurrences of the same string, of
   which only the earliest stays. What exceeds memory is held by Spark's shuffles
   and stored rows, not by the sort. A shard larger than ``SHARD_BYTES`` is sorted in pieces of whole anchors. An anchor of
   more than ``HOT`` fragments is split first: strings that hold it at the same
   few places share the bytes around it, and meet by these; those of more than
   ``HOT`` parts are split into single strings, which meet by their hashes. So
   no suffix array grows with the input.
4. The places found go back to their documents, which are cut.

Defined results: a null text is empty. Ids are expected to be distinct; places
found for an id apply to each row that repeats it. Rows with a null id lose
nothing and make no other lose. Extra columns are handed through by :func:`remove`.
"""

from __future__ import annotations

import hashlib
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, cut, join_counted, map_texts, quoted, unused
from .induced_sort import as_before, suffix_array
from .recompression import interval_hashes, mixed, prefix_hashes
from .substring_dedup import among, utf8

LENGTH = 100
GRAM = 32
#: Mean bytes between cuts.
ONE_IN = 256
#: Bytes of one suffix array (or one anchor), so that its arrays stay in a core's cache.
SHARD_BYTES = 1 << 19
#: Most fragments of one anchor that are sorted together (about 3 MiB).
HOT = (3 << 20) // (2 * LENGTH - GRAM)
#: Places of an anchor in its strings that one part of a split fragment spans.
PART = 18
#: Keys of split anchors that are broadcast; more are shuffled.
BROADCAST_KEYS = 1 << 20
#: Bytes of texts looked at together.
BATCH_BYTES = 1 << 16
_U = np.uint64


def batches_of(texts: list[bytes]):
    """Index ranges of at most ``BATCH_BYTES`` (or one text)."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > BATCH_BYTES:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


class Bytes:
    """The bytes of some texts, with the hashes of their pieces."""

    def __init__(self, texts: list[bytes], length: int, gram: int = GRAM):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        self.length, self.gram = length, gram
        m = max(0, len(self.raw) - length + 1)
        owner = np.repeat(np.arange(len(texts)), self.sizes)[:m]
        at = np.arange(m)
        inside = at + length <= (self.begin + self.sizes)[owner]
        self.at, self.owner = at[inside], owner[inside]  # starts of whole strings
        self.prefix = prefix_hashes(self.raw.astype(_U) + _U(1))
        p = np.arange(len(self.raw) - gram + 1) if m else np.empty(0, np.int64)
        self.pieces = interval_hashes(self.prefix, p, p + gram)

    def _runs(self, new: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) string start of each run of ``at``, given where runs begin."""
        heads = np.flatnonzero(new)
        return at[heads], at[np.append(heads[1:], len(at)) - 1]

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, document and first start of each chunk, and the chunk number of each string."""
        if not len(self.at):
            e = np.empty(0, np.int64)
            return e.astype(_U), e, e, e
        mark = np.zeros(len(self.raw) + 1, np.int64)
        mark[: len(self.pieces)] = mixed(self.pieces) % _U(ONE_IN) == 0
        group = np.cumsum(mark)[self.at]
        new = np.ones(len(self.at), bool)
        new[1:] = (group[1:] != group[:-1]) | (self.owner[1:] != self.owner[:-1])
        first, last = self._runs(new, self.at)
        doc = self.owner[new]
        names = mixed(interval_hashes(self.prefix, first, last + self.length) ^ _U(self.length))
        return names, doc, first - self.begin[doc], np.cumsum(new) - 1

    def fragments(self, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, first place in the batch, strings, anchor) of runs of fresh strings with one anchor."""
        at, owner = self.at[fresh], self.owner[fresh]
        if not len(at):
            e = np.empty(0, np.int64)
            return e, e, e, e.astype(_U)
        n = len(self.pieces)
        # the least piece of each string; the place in the low bits makes the leftmost of equals least
        bits = _U(32)  # a text's bytes are fewer; alike for texts of any length
        low = (self.pieces >> bits << bits) | np.arange(n).astype(_U)
        width, span = 1, self.length - self.gram + 1
        least = low
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[at], least[at + span - width])
        place = (least & ((_U(1) << bits) - _U(1))).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
        first, last = self._runs(new, at)
        return owner[new], first, last - first + 1, self.pieces[place[new]]


def anchor_places(bodies: list[bytes], anchors: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Where each fragment holds its anchor: the leftmost piece of that hash."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    begin = np.cumsum(sizes) - sizes
    prefix = prefix_hashes(np.frombuffer(b"".join(bodies), np.uint8).astype(_U) + _U(1))
    p = np.arange(int(sizes.sum()) - gram + 1)
    owner = np.repeat(np.arange(len(bodies)), sizes)[: len(p)]
    hit = p[(p + gram <= (begin + sizes)[owner]) & (interval_hashes(prefix, p, p + gram) == anchors[owner])]
    return hit[np.searchsorted(hit, begin)] - begin


def parted(bodies: list[bytes], anchors: np.ndarray, places: np.ndarray, length: int, step: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(fragment, first string, strings, key) of each fragment's parts.

    A part has the strings that hold the anchor at ``step`` neighbouring places. The
    key hashes the bytes that all of them hold, so equal strings get equal keys.
    """
    sizes = np.array([len(b) for b in bodies], np.int64)
    begin = np.cumsum(sizes) - sizes
    prefix = prefix_hashes(np.frombuffer(b"".join(bodies), np.uint8).astype(_U) + _U(1))
    count = sizes - length + 1
    owner = np.repeat(np.arange(len(bodies)), count)
    string = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    group = (places[owner] - string) // step
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (group[1:] != group[:-1])
    heads = np.flatnonzero(new)
    owner, first, group = owner[heads], string[heads], group[heads]
    at = begin[owner] + places[owner]
    low, high = group * step, np.minimum(group * step + step - 1, length - gram)
    common = interval_hashes(prefix, at - low, at - high + length)
    key = mixed(common + mixed(anchors[owner] + group.astype(_U) * _U(512) + _U(step)))
    return owner, first, np.diff(np.append(heads, len(string))), key


def _parts(rows: DataFrame, kind: str, length: int, step: int, placed: bool) -> DataFrame:
    """(anchor, id, a, body, p) of the parts of fragments; the key of a part is its anchor. Single strings come without a body."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        anchors, a = batch.column(0).to_numpy().view(_U), batch.column(2).to_numpy().astype(np.int64)
        bodies = batch.column(3).to_pylist()
        if not bodies:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), batch.column(1), pa.array([], pa.int32()), pa.array([], pa.binary()), pa.array([], pa.int32())], names)
        places = batch.column(4).to_numpy().astype(np.int64) if placed else anchor_places(bodies, anchors)
        of, first, n, key = parted(bodies, anchors, places, length, step)
        cut_out = [bodies[o][x:z] if step > 1 else b"" for o, x, z in zip(of.tolist(), first.tolist(), (first + n + length - 1).tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), batch.column(1).take(pa.array(of)), pa.array((a[of] + first).astype(np.int32)), pa.array(cut_out, pa.binary()), pa.array((places[of] - first).astype(np.int32))], names
        )

    names = ["anchor", "id", "a", "body", "p"]
    return map_texts(rows, names if placed else names[:4], run, f"anchor long, id {kind}, a int, body binary, p int")


def split(hot: DataFrame, length: int) -> tuple[DataFrame, DataFrame | None]:
    """Fragments (anchor, id, a, body) of hot anchors as shards of at most ``HOT`` parts, and (id, a, z) of strings found on the way."""
    kind = hot.schema["id"].dataType.simpleString()
    parts = _parts(hot, kind, length, PART, False)
    counts = cut(parts.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    full = counts.where(F.col("c") > HOT).select("anchor")
    n = full.count()
    if not n:
        return parts.join(counts, "anchor", "left_semi").select("anchor", "id", "a", "body"), None
    full = F.broadcast(full) if n <= BROADCAST_KEYS else full
    cold = parts.join(full, "anchor", "left_anti").join(counts, "anchor", "left_semi").select("anchor", "id", "a", "body")
    # one phrase in very many surroundings is one string of very many rows
    strings = cut(_parts(parts.join(full, "anchor", "left_semi"), kind, length, 1, True).select("anchor", "id", "a"))
    earliest = cut(strings.groupBy("anchor").agg(F.min(F.struct("id", "a")).alias("o"), F.count(F.lit(1)).alias("c")).where("c > 1"))
    later = join_counted(strings, earliest, ["anchor"]).where("id > o.id or a > o.a")
    return cold, later.select("id", "a", (F.col("a") + 1).alias("z"))


def seals(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A second hash of the byte ranges, independent of the polynomial ones; who agrees in both is taken for equal."""
    view = memoryview(raw.tobytes())
    digest = b"".join([hashlib.blake2b(view[a:z], digest_size=8).digest() for a, z in zip(first.tolist(), last.tolist(), strict=True)])
    return np.frombuffer(digest, "<u8")


def repeated_ranges(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """(id, ranges array<struct<a, z>>): starts of strings that occur earlier, as ranges [a, z)."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    signed = lambda x: pa.array((np.concatenate(x) if x else np.empty(0, _U)).view(np.int64))
    whole = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)

    def parts(batch: pa.RecordBatch):
        texts = utf8(batch.column(1))
        for lo, hi in batches_of(texts):
            yield lo, hi, Bytes(texts[lo:hi], length)

    def fresh_strings(b: Bytes, lists: pa.Array, lo: int, hi: int) -> np.ndarray:
        """Which strings are outside of the chunks that start at the listed places."""
        _, doc, start, number = b.chunks()
        return ~among(start.astype(_U), doc, lists, lo, hi - lo)[number] if len(number) else np.zeros(0, bool)

    def chunk_scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, seals_, docs_, starts, counts = [], [], [], [], []
        for lo, _, b in parts(batch):
            name, doc, start, number = b.chunks()
            names.append(name)
            count = np.bincount(number, minlength=len(name))
            first = start + b.begin[doc]
            seals_.append(seals(b.raw, first, first + count + length - 1))
            docs_.append(doc + lo)
            starts.append(start)
            counts.append(count)
        return pa.RecordBatch.from_arrays([signed(names), signed(seals_), batch.column(0).take(pa.array(whole(docs_, np.int64))), pa.array(whole(starts, np.int64)), pa.array(whole(counts, np.int32))], ["v", "w", "id", "a", "n"])

    with Stored(map_texts(named, ["id", "text"], chunk_scan, f"v long, w long, id {kind}, a long, n int", 256)) as rows:
        earliest = cut(rows.groupBy("v", "w").agg(F.min(F.struct("id", "a")).alias("o"), F.count(F.lit(1)).alias("c")).where("c > 1"))
        copies = join_counted(rows, earliest, ["v", "w"]).where("id > o.id or a > o.a")
        copied = cut(copies.groupBy("id").agg(F.collect_set("a").alias("starts"), F.collect_set(F.struct(F.col("a").cast("int").alias("a"), (F.col("a") + F.col("n")).cast("int").alias("z"))).alias("ranges")))

    def anchor_scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, docs_, counts = [], [], []
        for lo, hi, b in parts(batch):
            doc, _, _, name = b.fragments(fresh_strings(b, batch.column(2), lo, hi))
            ends = np.searchsorted(doc, np.arange(hi - lo + 1))
            for i in range(hi - lo):
                own, n = np.unique(name[ends[i] : ends[i + 1]], return_counts=True)
                names.append(own)
                counts.append(n)
                docs_.append(np.full(len(own), lo + i))
        return pa.RecordBatch.from_arrays([signed(names), batch.column(0).take(pa.array(whole(docs_, np.int64))), pa.array(whole(counts, np.int32))], ["anchor", "id", "n"])

    left = named.join(copied.select("id", "starts"), "id", "left")
    with Stored(map_texts(left, ["id", "text", "starts"], anchor_scan, f"anchor long, id {kind}, n int", 256)) as rows:
        shared = cut(rows.groupBy("anchor").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("c")).where("n > 1"))
        named_hot = F.when(F.col("n") > HOT, F.col("anchor")).alias("hot")
        wanted = cut(join_counted(rows.select("anchor", "id"), shared, ["anchor"]).select("id", "anchor", named_hot).groupBy("id").agg(F.collect_set("anchor").alias("anchors"), F.collect_set("hot").alias("hot")))

    def fragment_scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, prints, seals_, docs_, starts, counts, bodies = [], [], [], [], [], [], []
        for lo, hi, b in parts(batch):
            doc, first, count, name = b.fragments(fresh_strings(b, batch.column(2), lo, hi))
            keep = among(name, doc, batch.column(3), lo, hi - lo)
            doc, first, count, name = doc[keep], first[keep], count[keep], name[keep]
            last = first + count + length - 1
            names.append(name)
            seals_.append(seals(b.raw, first, last))
            prints.append(mixed(interval_hashes(b.prefix, first, last) + name))
            docs_.append(doc + lo)
            starts.append(first - b.begin[doc])
            counts.append(count)
            view = b.raw.tobytes()
            bodies += [view[x:y] for x, y in zip(first.tolist(), last.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [signed(names), signed(prints), signed(seals_), batch.column(0).take(pa.array(whole(docs_, np.int64))), pa.array(whole(starts, np.int32)), pa.array(whole(counts, np.int32)), pa.array(bodies, pa.binary())],
            ["anchor", "print", "seal", "id", "a", "n", "body"],
        )

    hot = cut(wanted.select(F.explode("hot").alias("anchor")).distinct())
    n_hot = hot.count()
    asked = named.join(wanted.select("id", "anchors"), "id").join(copied.select("id", "starts"), "id", "left")
    with Stored(map_texts(asked, ["id", "text", "starts", "anchors"], fragment_scan, f"anchor long, print long, seal long, id {kind}, a int, n int, body binary", 64)) as rows, ExitStack() as more:
        key = ["anchor", "print", "seal"]
        origin = cut(rows.groupBy(*key).agg(F.min(F.struct("id", "a")).alias("o"), F.count(F.lit(1)).alias("c")))
        is_first = (F.col("id") == F.col("o.id")) & (F.col("a") == F.col("o.a"))
        again = cut(join_counted(rows.drop("body"), origin.where("c > 1"), key).where(~is_first).select("id", "a", (F.col("a") + F.col("n")).alias("z")))
        # fragments that meet another one under their anchor; a repeated id may repeat a first place
        several = origin.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor")
        # the body of each first one, found by its place
        held_at = origin.select(*key, F.col("o.id").alias("id"), F.col("o.a").alias("a")).join(several, "anchor", "left_semi")
        first = rows.drop("n").join(held_at, [*key, "id", "a"], "left_semi").select("anchor", "id", "a", "body")
        found = again
        if n_hot:
            hot = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
            held = more.enter_context(Stored(first.join(hot, "anchor", "left_semi")))
            parts, later = split(held, length)
            shards = first.join(hot, "anchor", "left_anti").unionByName(parts)
            found = found if later is None else found.unionByName(later)
        else:
            shards = first
        most = SHARD_BYTES
        dealt = shards.repartition("anchor").sortWithinPartitions("anchor", "id", "a")

        def sort_shards(batches):
            names, ids, starts, bodies, size = [], [], [], [], 0
            for b in batches:
                kind_of = b.column(1).type
                for name, i, a, body in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True):
                    if size > most and name != names[-1]:
                        yield ranges(sorted_shard(ids, starts, bodies, length), kind_of)
                        names, ids, starts, bodies, size = [], [], [], [], 0
                    names.append(name)
                    ids.append(i)
                    starts.append(a)
                    bodies.append(body)
                    size += len(body)
            if bodies:
                yield ranges(sorted_shard(ids, starts, bodies, length), kind_of)

        def ranges(found, kind_of):
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], kind_of), pa.array([x[1] for x in found], pa.int32()), pa.array([x[2] for x in found], pa.int32())], ["id", "a", "z"])

        inner = dealt.mapInArrow(sort_shards, f"id {kind}, a int, z int")
        whole_chunks = copied.select("id", F.explode("ranges").alias("r")).select("id", "r.a", "r.z")
        out = cut(found.unionByName(inner).unionByName(whole_chunks).groupBy("id").agg(F.collect_set(F.struct("a", "z")).alias("ranges")))
    return out


def sorted_shard(ids: list, starts: list[int], bodies: list[bytes], length: int) -> list[tuple]:
    """Ranges of string starts in a shard's fragments that occur earlier in the shard.

    The suffix array covers all fragments, joined by a byte that ends each (its value
    may occur in texts: strings that are judged never reach it).
    """
    raw = np.frombuffer(b"\x00".join(bodies) + b"\x00", np.uint8)
    sizes = np.array([len(b) + 1 for b in bodies])
    begin = np.cumsum([0, *sizes[:-1].tolist()])
    owner = np.repeat(np.arange(len(bodies)), sizes)
    judged = np.arange(len(raw)) - begin[owner] <= sizes[owner] - 1 - length
    order = suffix_array(raw, length)
    order = order[judged[order]]
    group = np.cumsum(~as_before(raw, order, length)) - 1
    # a string's own place within a document is its fragment's start plus its offset
    key = sorted({i for i in ids})
    number = {i: n for n, i in enumerate(key)}
    doc = np.array([number[i] for i in ids])[owner[order]]
    start = np.array(starts)[owner[order]] + order - begin[owner[order]]
    where = doc.astype(np.int64) << 32 | start
    least = np.full(int(group[-1]) + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, group, where)
    later = where > least[group]
    hit = np.unique(where[later])
    if not len(hit):
        return []
    edge = np.flatnonzero(np.diff(hit) != 1) + 1
    return [(key[int(r[0] >> 32)], int(r[0] & 0xFFFFFFFF), int(r[-1] & 0xFFFFFFFF) + 1) for r in np.split(hit, edge)]


def kept_mask(size: int, ranges: pa.Scalar, length: int) -> np.ndarray:
    """False for each byte covered by a string that starts in one of the ranges."""
    step = np.zeros(size + 1, np.int64)
    if ranges.is_valid:
        a = ranges.values.field("a").to_numpy().astype(np.int64)
        z = ranges.values.field("z").to_numpy().astype(np.int64) + length - 1
        np.add.at(step, np.minimum(a, size), 1)
        np.add.at(step, np.minimum(z, size), -1)
    return np.cumsum(step)[:size] == 0


def _with_ranges(docs: DataFrame, length: int, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` with the ranges of repeated strings, and the name of that column."""
    key, ranges = unused(docs.columns, "_fd_id", "_fd_ranges")
    found = repeated_ranges(docs, length, id_col, text_col).withColumnsRenamed({"id": key, "ranges": ranges})
    return docs.join(found, F.col(quoted([id_col])[0]) == F.col(key), "left").drop(key), ranges


def digests(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_bytes, n_removed, n_spans and the digest of the remaining bytes of every document."""
    joined, column = _with_ranges(docs.select(id_col, text_col), length, id_col, text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, gone, spans, sha = [], [], [], []
        for raw, ranges in zip(utf8(batch.column(1)), batch.column(2), strict=True):
            n.append(len(raw))
            if not ranges.is_valid:
                gone.append(0)
                spans.append(0)
                sha.append(hashlib.sha256(raw).hexdigest())
                continue
            keep = kept_mask(len(raw), ranges, length)
            gone.append(int((~keep).sum()))
            spans.append(int((keep[:-1] & ~keep[1:]).sum()) + int(len(raw) > 0 and not keep[0]))
            sha.append(hashlib.sha256(np.frombuffer(raw, np.uint8)[keep].tobytes()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(joined, [id_col, text_col, column], run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string", 256).withColumnRenamed("id", id_col)


def remove(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated strings cut out; a cut inside a character drops the character's rest."""
    joined, column = _with_ranges(docs, length, id_col, text_col)
    names = docs.columns
    place = names.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for text, ranges in zip(batch.column(place).to_pylist(), batch.column(len(names)), strict=True):
            if ranges.is_valid:
                raw = np.frombuffer(text.encode(), np.uint8)
                text = raw[kept_mask(len(raw), ranges, length)].tobytes().decode(errors="ignore")
            texts.append(text)
        out = [batch.column(i) for i in range(len(names))]
        out[place] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(out, names)

    return map_texts(joined, quoted([*names, column]), run, docs.schema, 256)
