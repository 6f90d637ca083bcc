"""Fill-in-the-middle transformation with succinct rank and select.

A batch's texts lie back to back in one byte buffer. One packed bit vector marks
the last byte of every unit (a line with its line feed, or what follows the last
one), another the first byte of every code point; a directory holds the ones
before each block of 512 bits. The total popcount between a text's ends is its
number of units n; two ranks below n + 1, drawn by a hash of the id, are turned
into byte cuts by select; ranks over the second vector count code points. No text
is split into lines.

The text between the cuts (the middle) is moved behind prefix and suffix:

* psm: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* spm: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* plain: the text as it is (empty, holding a mark, or not drawn)

:func:`restore` rebuilds the text from output and form alone.

Defined results: a null text is the empty text (plain, n = 0); a null id draws as
an empty one. Equal rows give equal rows, each of its own. Cuts may coincide or
lie at an end, so any part may be empty. Texts are handled whole, in pieces of
at most ``PIECE_BYTES`` or one text. Columns other than id and text are ignored,
whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, sha_hex, slices_of

#: Percent of the texts that are transformed, and of these the percent in the order suffix, prefix, middle.
RATE, SPM = 100, 50
SEED = "7"
#: Bytes of text looked at together.
PIECE_BYTES = 4 << 20

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
_LINE_FEED = 10
#: Words of 64 bits in a block of the directory.
_BLOCK = 8


class BitVector:
    """Packed bits with a directory of the ones before each block; answers many ranks or selects at once."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        size = 8 * _BLOCK
        whole = np.zeros((len(packed) // size + 1) * size, np.uint8)
        whole[: len(packed)] = packed
        self.words = whole.view(np.uint64).reshape(-1, _BLOCK)
        self.counts = np.bitwise_count(self.words).astype(np.int64)
        self.directory = np.concatenate([[0], np.cumsum(self.counts.sum(1))])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block, word, bit = at >> 9, (at >> 6) & 7, (at & 63).astype(np.uint64)
        earlier = (self.counts[block] * (np.arange(_BLOCK) < word[:, None])).sum(1)
        partial = self.words[block, word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.directory[block] + earlier + np.bitwise_count(partial)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The place of each k-th one, counted from 1."""
        block = np.searchsorted(self.directory, k, "left") - 1
        upto = np.cumsum(self.counts[block], axis=1)
        left = k - self.directory[block]
        word = (upto < left[:, None]).sum(1)
        left -= np.where(word > 0, np.take_along_axis(upto, np.maximum(word - 1, 0)[:, None], 1)[:, 0], 0)
        bits = np.unpackbits(self.words[block, word][:, None].view(np.uint8), axis=1, bitorder="little")
        bit = (np.cumsum(bits, axis=1, dtype=np.int64) < left[:, None]).sum(1)
        return (block << 9) + (word << 6) + bit


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls: its own buffers, from its first text on."""
    if pa.types.is_large_string(texts.type) or not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string())
    _, places, values = texts.buffers()
    offsets = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    body = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]] if values is not None else np.zeros(0, np.uint8)
    return body, offsets - offsets[0]


def cuts_of(body: np.ndarray, offsets: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n, cuts, chars): units of each text, the byte places of its two cuts, code points before each cut.

    draws: two numbers a text; each is taken modulo n + 1.
    """
    start, end = offsets[:-1], offsets[1:]
    last = body == _LINE_FEED
    last[end[end > start] - 1] = True
    units = BitVector(last)
    before = units.rank(start)
    n = units.rank(end) - before
    ranks = np.sort(draws % (n + 1)[:, None], axis=1)
    cuts = np.repeat(start[:, None], 2, axis=1)
    some = ranks > 0
    cuts[some] = units.select((before[:, None] + ranks)[some]) + 1
    points = BitVector((body & 0xC0) != 0x80)
    chars = points.rank(cuts.ravel()).reshape(-1, 2) - points.rank(start)[:, None]
    return n, cuts, chars


def _rearranged(piece: pa.RecordBatch, rate: int, spm: int) -> pa.RecordBatch:
    """Rows (id, text, hash) of a piece, transformed."""
    body, offsets = buffer_of(pc.fill_null(piece.column(1), ""))
    digits = [(int(h[:8], 16), int(h[8:16], 16), int(h[16:24], 16), int(h[24:32], 16)) for h in piece.column(2).to_pylist()]
    draws = np.array(digits, np.int64).reshape(-1, 4)
    n, cuts, chars = cuts_of(body, offsets, draws[:, :2])
    whole = body.tobytes()
    forms, prefixes, middles, outputs = [], [], [], []
    p, s, m = _MARKS
    for i, (a, z) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if a == z or draws[i, 2] % 100 >= rate or any(whole.find(mark, a, z) >= 0 for mark in _MARKS):
            forms.append("plain")
            prefixes.append(None)
            middles.append(None)
            outputs.append(whole[a:z])
            continue
        first, second = cuts[i].tolist()
        prefix, middle, suffix = whole[a:first], whole[first:second], whole[second:z]
        form = "spm" if draws[i, 3] % 100 < spm else "psm"
        forms.append(form)
        prefixes.append(int(chars[i, 0]))
        middles.append(int(chars[i, 1] - chars[i, 0]))
        outputs.append(b"".join((p, prefix, s, suffix, m, middle) if form == "psm" else (s, suffix, p, prefix, m, middle)))
    return pa.RecordBatch.from_arrays(
        [piece.column(0), pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())],
        ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``id_col``, n, form, prefix_chars, middle_chars and output of every text; one narrow pass."""
    drawn = sha_hex(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for piece in slices_of(batches, 1, PIECE_BYTES):
            yield _rearranged(piece, rate, spm)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), drawn.alias("h"))
    return rows.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string").withColumnRenamed("id", id_col)


def restore(output: Column, form: Column) -> Column:
    """The text that was transformed; DataFrame functions only."""
    parts = F.split(output, "<[PSM]>", -1)
    one = lambda n: F.element_at(parts, n)  # noqa: E731  the first part lies before the first mark and is empty
    return F.when(form == "psm", F.concat(one(2), one(4), one(3))).when(form == "spm", F.concat(one(3), one(4), one(2))).otherwise(output)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The transformation with hashes in place of the texts."""
    done = transform(docs, id_col, text_col)
    return done.select(
        id_col, "n", "form", "prefix_chars", "middle_chars", sha_hex(F.col("output")).alias("output_sha256"), sha_hex(restore(F.col("output"), F.col("form"))).alias("restored_sha256")
    )


def duckdb_sql() -> str:
    """The digests in DuckDB SQL: texts are split into lines and put together again."""
    number = lambda k: f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT"
    piece = lambda a, z: f"coalesce(array_to_string(u[{a}:{z}], ''), '')"
    return rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
      s AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, {number(0)} AS h1, {number(1)} AS h2, {number(2)} AS h3, {number(3)} AS h4 FROM d),
      c AS (SELECT *, len(u)::BIGINT AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS z,
        CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM s),
      p AS (SELECT *, {piece(1, 'a')} AS p1, {piece('a + 1', 'z')} AS m1, {piece('z + 1', 'n')} AS s1 FROM c)
      SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p1) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m1) END AS middle_chars,
        sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || p1 || '{SUFFIX}' || s1 || '{MIDDLE}' || m1 WHEN 'spm' THEN '{SUFFIX}' || s1 || '{PREFIX}' || p1 || '{MIDDLE}' || m1 ELSE t END) AS output_sha256,
        sha256(t) AS restored_sha256 FROM p"""
