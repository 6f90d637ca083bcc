"""JSON arrays of any size: files are read by byte ranges, and written in pieces that make one array.

Reading. Spark's text reader deals a file out in splits whose records end at a
closing brace, whether the array stands on one line or on many. Where a split
starts, it may be inside a string and at any depth; so a first pass sums up each
split for both cases (quotes, depth gained, commas and brackets by depth), these
sums are chained in file order (one small row for each split), and a second pass,
now knowing where each split starts, cuts out the elements. An element that spans
splits is put together from its pieces.

Writing. Rows are range-sorted and numbered; the first one opens the array, the last
one closes it, and each range is one file, so the files in the order of their names
are one pretty array. Spark's committer shows them all at once, or none.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import numbered

_END = b"}"
#: JSON's white space.
_BLANK = b" \t\r\n"
_QUOTE, _ESCAPE, _COMMA, _OPEN, _CLOSE = ord('"'), ord("\\"), ord(","), (ord("{"), ord("[")), (ord("}"), ord("]"))


def _segments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(value, path, start, size): texts up to each closing brace, which is left out, with their split's start."""
    texts = spark.read.option("lineSep", _END.decode()).text(paths)
    meta = F.col("_metadata")
    return texts.select("value", meta["file_path"].alias("path"), meta["file_block_start"].alias("start"), meta["file_size"].alias("size"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(path, start, size, bytes) of consecutive records of one split within a batch."""
    for batch in batches:
        path, start, size = (batch.column(i).to_pylist() for i in (1, 2, 3))
        values = batch.column(0).cast(pa.binary()).to_pylist()
        at = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or (path[i], start[i]) != (path[at], start[at]):
                yield path[at], start[at], size[at], b"".join(v + _END for v in values[at:i])
                at = i


def _scan(raw: np.ndarray) -> tuple[np.ndarray, int]:
    """(whether an even number of quotes stands before each byte, 1 if the number of all is odd). A chunk starts after a brace."""
    place = np.arange(len(raw))
    escape = raw == _ESCAPE
    plain = np.maximum.accumulate(np.where(escape, -1, place))  # the last byte so far that is no backslash
    before = np.concatenate([[-1], plain[:-1]])
    quote = (raw == _QUOTE) & ((place - 1 - before) % 2 == 0)
    count = np.cumsum(quote)
    return (count - quote) % 2 == 0, int(count[-1] % 2) if len(raw) else 0


def _steps(raw: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(depth after each byte from 0, opening, closing and comma bytes) outside of strings."""
    opens = np.isin(raw, _OPEN) & outside
    closes = np.isin(raw, _CLOSE) & outside
    return np.cumsum(opens.astype(np.int64) - closes), opens, closes, (raw == _COMMA) & outside


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row (path, start, size, sums) for each run of a split's records."""
    for path, start, size, body in _chunks(batches):
        raw = np.frombuffer(body, np.uint8)
        even, odd = _scan(raw)
        cases = []
        for outside in (even, ~even):
            depth, opens, closes, commas = _steps(raw, outside)
            cases.append((int(depth[-1]), Counter(depth[commas | opens].tolist()), Counter(depth[closes].tolist())))
        sums = pickle.dumps((len(raw), odd, cases, body.lstrip(_BLANK)[:1]))
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([start], pa.int64()), pa.array([size], pa.int64()), pa.array([sums], pa.binary())], ["path", "start", "size", "sums"])


def _chained(rows: list) -> tuple[dict, list]:
    """({(path, start): (inside a string, depth, element)}, [(path, array, sound, last element, closed by the end of the file)])."""
    starts, files, by_path = {}, [], {}
    for r in rows:
        by_path.setdefault(r["path"], []).append(r)
    for path, parts in by_path.items():
        inside, depth, element, total, head, ends = 0, 0, 0, 0, b"", 0
        for r in sorted(parts, key=lambda r: (r["start"], r["n"])):
            starts.setdefault((path, r["start"]), (inside, depth, element))
            size, odd, cases, first = pickle.loads(r["sums"])
            head = head or first
            gained, after, closed = cases[inside]
            element += after[1 - depth] + closed[-depth]
            ends += closed[-depth]
            inside, depth, total = inside ^ odd, depth + gained, total + size
        added = total > parts[0]["size"]  # the last record had no brace of its own
        files.append((path, head == b"[", inside == 0 and depth == (-1 if added else 0) and ends == 1, element, added))
    return starts, files


def _cutter(shared):
    """Elements of splits whose starts are known: (path, element, start, part, edge, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, rest, number = None, None, [], 0

        def row(items):
            names = ["path", "element", "start", "part", "edge", "body"]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([i[n] for i in items], k) for n, k in enumerate(kinds)], names)

        def last():
            return (*key[:1], state[2], key[1], number, True, b"".join(rest).decode(errors="replace"))

        for path, start, _, body in _chunks(batches):
            if (path, start) != key:
                if key is not None:
                    yield row([last()])
                key, state, rest, number = (path, start), shared.value[(path, start)], [], 0
            inside, depth, element = state
            raw = np.frombuffer(body, np.uint8)
            even, odd = _scan(raw)
            after, opens, closes, commas = _steps(raw, ~even if inside else even)
            after = after + depth
            at = np.flatnonzero(((commas | opens) & (after == 1)) | (closes & (after == 0))).tolist()
            out, from_ = [], 0
            for a in at:
                rest.append(body[from_:a])
                out.append((path, element, start, number, number == 0, b"".join(rest).decode(errors="replace")))
                rest, from_, element, number = [], a + 1, element + 1, number + 1
            rest.append(body[from_:])
            state = (inside ^ odd, int(after[-1]), element)
            if out:
                yield row(out)
        if key is not None:
            yield row([last()])

    return run


def array_elements(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """(elements, files): (path, pos, body) of each element, and (path, array, sound) of each file with a byte.

    ``pos`` counts from 0. ``array`` tells whether a file begins as an array. One that does
    is sound if quotes and brackets close and there is nothing but white space around;
    whether elements are JSON is not looked at. Files of other kinds give no elements.
    """
    segments = _segments(spark, paths)
    # rows of one split stand in their order in one task
    sums = segments.mapInArrow(_summed, "path string, start long, size long, sums binary").withColumn("n", F.monotonically_increasing_id())
    starts, known = _chained(sums.collect())  # a row for each batch of a split
    shared = spark.sparkContext.broadcast(starts)  # an entry for each split
    pieces = segments.mapInArrow(_cutter(shared), "path string, element long, start long, part int, edge boolean, body string")
    whole = pieces.where("not edge").select("path", "element", "body")
    spanning = pieces.where("edge").groupBy("path", "element").agg(F.array_sort(F.collect_list(F.struct("start", "part", "body"))).alias("p"))  # at most two a split
    joined = spanning.select("path", "element", F.array_join(F.transform("p", lambda p: p["body"]), "").alias("body"))
    files = spark.createDataFrame(known, "path string, array boolean, sound boolean, last long, added boolean")
    trimmed = F.regexp_replace(F.col("body"), r"^[ \t\r\n]+|[ \t\r\n]+$", "")
    every = whole.unionByName(joined).join(F.broadcast(files.where("array")), "path").withColumn("body", trimmed)
    around = (F.col("element") == 0) | (F.col("element") == F.col("last"))
    stray = every.where(around & (F.col("body") != F.when(F.col("added") & (F.col("element") == F.col("last")), "}").otherwise(""))).select("path").distinct().withColumn("_stray", F.lit(True))
    sound = files.join(stray, "path", "left").select("path", "array", (F.col("sound") & F.col("_stray").isNull()).alias("sound"))
    inner = every.where(~around & ~((F.col("last") == 2) & (F.col("body") == ""))).select("path", (F.col("element") - 1).alias("pos"), "body")
    return inner, sound


def array_lines(df: DataFrame, order: list[str], drop: tuple[str, ...] = ()) -> DataFrame:
    """(n, value): the lines of one pretty JSON array, range by range; an empty table is one line."""
    columns = [c for c in df.columns if c not in drop]
    body = F.to_json(F.struct(*columns), {"pretty": "true", "ignoreNullFields": "false"})
    rows = numbered(df, order, "_n")
    total = rows.count()
    if not total:
        return df.sparkSession.createDataFrame([(1, "[]")], "n long, value string")
    opened = F.when(F.col("_n") == 1, F.lit("[\n")).otherwise("")
    closed = F.when(F.col("_n") == total, F.lit("\n]")).otherwise(",")
    return rows.select(F.col("_n").alias("n"), F.concat(opened, body, closed).alias("value"))


def write_array(df: DataFrame, path: str, order: list[str], drop: tuple[str, ...] = ()) -> None:
    """``df`` as one JSON array in files that follow one another by name."""
    array_lines(df, order, drop).select("value").write.mode("overwrite").text(path)
