"""BPE encoding and decoding: a backtracking encoder over longest token matches.

A vocabulary file of a public tokenizer (``tokenizers`` JSON format, BPE model
with an end-of-word suffix and byte-level symbols) is compiled into

* an Aho-Corasick automaton over all tokens, which reports every token that
  ends at every position of a word in one pass,
* a *pair-compatibility table*: two adjacent tokens are compatible when merging
  their concatenation by rank would leave exactly these two,
* an *offset table*: all token strings in one blob plus start offsets, by which
  ids are decoded with one vectorised gather.

The encoder walks a word left to right. The automaton proposes the longest token
at each position; a token that is not compatible with the one before gives way
to its longest proper prefix that is a token (the *prefix table*), and
positions from which no token leads on are left for good. So each position is
left at most once: the result is the exact merge result in time linear in the
word's length.

Defined results: a null text counts as the empty text (no ids); texts are
encoded whole, however long; each row is encoded on its own, repeated rows
alike; an empty table gives no rows. Columns other than the id and the text are
not read, so their names do not matter. A vocabulary file whose normaliser or
split pattern is another than the one written out here raises an error.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import held, slices_of

#: Words remembered by a worker in each of two generations (some 50 MB each at most).
CACHE_WORDS = 150_000
#: Shift that marks the last symbol of a word (symbols lie far below it).
LAST = 0x1000
#: Compatible pairs remembered by a worker before the table starts afresh.
COMPATIBLE_PAIRS = 400_000
#: Bytes of texts encoded together (or one text).
TEXT_BYTES = 3 << 20
#: Longer words are encoded each time, so that a cache holds small entries only.
CACHE_BYTES = 32

# The normaliser and the split pattern that the encoder carries out.
NORMALISER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@dataclass
class Spec:
    """What the encoder needs from a tokenizer file; small and of fixed size."""

    vocab: dict[str, int]
    merges: list[tuple[str, str]]
    suffix: str
    added: dict[str, int]
    pattern: str
    key: str = field(default="")


def load_spec(path: str) -> Spec:
    """Read a tokenizer file on the driver (``path`` is the caller's parameter)."""
    with open(path, encoding="utf-8") as f:
        raw = f.read()
    j = json.loads(raw)
    model = j["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else (m[0], m[1]) for m in model["merges"]]
    split = next(p for p in j["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    if j["normalizer"]["normalizers"] != NORMALISER or split["pattern"]["Regex"] != PATTERN:
        raise ValueError(f"{path}: the encoder does not know this normaliser or split pattern")
    return Spec(
        vocab=model["vocab"],
        merges=merges,
        suffix=model["end_of_word_suffix"] or "",
        added={a["content"]: a["id"] for a in j["added_tokens"]},
        pattern=split["pattern"]["Regex"],
        key=hashlib.sha256(raw.encode()).hexdigest(),
    )


def byte_symbols() -> list[str]:
    """The printable character that byte-level BPE uses for each byte value."""
    keep = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, extra = {b: chr(b) for b in keep}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


class Memo:
    """What was made of short keys, in two generations of which the older goes first."""

    def __init__(self):
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def all_of(self, keys: list[bytes], make) -> list[bytes]:
        out = list(map(self.new.get, keys))
        for i in [i for i, v in enumerate(out) if v is None]:
            key = keys[i]
            got = self.old.get(key)
            if got is None:
                got = make(key)
            out[i] = got
            if len(key) <= CACHE_BYTES:
                self.new[key] = got
        if len(self.new) > CACHE_WORDS:
            self.new, self.old = {}, self.new
        return out


def kind_of(c: str) -> int:
    """Class of a character in the split pattern."""
    return LETTER if regex.match(r"\p{L}", c) else NUMERAL if regex.match(r"\p{N}", c) else BLANK if regex.match(r"\s", c) else OTHER


BLANK, LETTER, NUMERAL, OTHER = range(4)
_ASCII_KIND = np.array([kind_of(chr(b)) if b < 128 else OTHER for b in range(256)], np.uint8)
#: The pattern's endings after an apostrophe, of one byte and of two.
_ENDINGS_1 = np.frombuffer(b"stmd", np.uint8)
_ENDINGS_2 = np.array([x[0] << 8 | x[1] for x in (b"re", b"ve", b"ll")], np.uint16)
#: By size, what of eight bytes belongs to a token.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Encoder:
    """Compiled tables for one vocabulary; built once in each Python worker."""

    def __init__(self, spec: Spec):
        self.spec = spec
        self.symbols = byte_symbols()
        unit = self._unit
        order: dict[str, int] = {}
        self.split: list[tuple[int, int]] = []
        self.ids: list[int] = []
        merged = {a + b for a, b in spec.merges}
        for token in sorted((t for t in spec.vocab if t not in merged), key=spec.vocab.get):
            if len(unit(token)) == 1:
                order[token] = len(self.ids)
                self.split.append((order[token], order[token]))
                self.ids.append(spec.vocab[token])
        self.pair: dict[int, int] = {}  # (left << 16 | right) -> their merge
        for a, b in spec.merges:
            token = a + b
            if a not in order or b not in order or token in order:
                continue
            n = order[token] = len(self.ids)
            self.split.append((order[a], order[b]))
            self.pair[order[a] << 16 | order[b]] = n
            self.ids.append(spec.vocab[token])
        numbers = {unit(token): n for token, n in order.items()}
        self.automaton = ahocorasick.Automaton()
        self.sizes = [1] * len(self.ids)
        self.shorter = [-1] * len(self.ids)  # prefix table: the longest proper prefix that is a token
        for text, n in numbers.items():
            self.sizes[n] = len(text)
            for end in range(len(text) - 1, 0, -1):
                if text[:end] in numbers:
                    self.shorter[n] = numbers[text[:end]]
                    break
            self.automaton.add_word(text, n)
        self.automaton.make_automaton()
        self.coded = [i.to_bytes(4, "little") for i in self.ids]
        assert len(self.ids) < 1 << 16, "pair keys hold two 16-bit token numbers"
        self.compatible: dict[int, bool] = {}  # the pair-compatibility table, filled as pairs are met
        self.cut = regex.compile("(" + "|".join(regex.escape(a) for a in spec.added) + ")").split if spec.added else None
        self.words = Memo()
        # offset table: strings of all ids, each followed by one space
        size = max([*spec.vocab.values(), *spec.added.values()]) + 1
        strings = [b""] * size
        for t, i in [*spec.vocab.items(), *spec.added.items()]:
            strings[i] = t.encode() + b" "
        self.lengths = np.array([len(s) for s in strings], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.blob = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.decimal = [str(i) for i in range(size)]

    def _unit(self, token: str) -> str:
        """A token as one character per symbol; the word's last symbol is shifted."""
        s = self.spec.suffix
        if s and token.endswith(s) and len(token) > len(s):
            body = token[: -len(s)]
            return body[:-1] + chr(ord(body[-1]) + LAST)
        return token

    def _fits(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves ``a`` and ``b`` side by side."""
        split, pair = self.split, self.pair
        limit = len(split)
        while True:
            joined = pair.get(a << 16 | b)
            if joined is not None and joined < limit:
                return False
            if a > b:
                limit, a = a, split[a][1]
                if a == limit:
                    limit, b = b + 1, split[b][0]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, split[b][0]
                if b + 1 == limit:
                    limit, a = a, split[a][1]
                    if a == limit:
                        return True

    def encode_word(self, word: bytes) -> bytes:
        """Exact ids of one pre-token (its UTF-8 bytes), as little-endian unsigned 32-bit integers."""
        text = word.decode("latin-1")
        if not word.isalnum():  # such bytes are their own symbols
            text = text.translate(self.symbols)
        text = text[:-1] + chr(ord(text[-1]) + LAST)
        n = len(text)
        sizes, shorter, table, fits, longest = self.sizes, self.shorter, self.compatible, self._fits, self.automaton.iter_long
        out: list[int] = []
        dead: set[int] = set()
        pos, last = 0, -1
        ahead = longest(text)  # longest tokens one after the other, while each is taken
        token = next(ahead)[1]
        while True:
            taken = token
            while taken >= 0:
                if pos + sizes[taken] not in dead:
                    if last < 0:
                        break
                    key = last << 16 | taken
                    good = table.get(key)
                    if good is None:
                        good = table[key] = fits(last, taken)
                    if good:
                        break
                taken = shorter[taken]
            if taken < 0:  # nothing leads on from here
                dead.add(pos)
                out.pop()
                pos -= sizes[last]
                token, last = shorter[last], out[-1] if out else -1
                ahead = None
                continue
            out.append(taken)
            pos += sizes[taken]
            if pos == n:
                break
            last = taken
            if taken != token or ahead is None:
                ahead = longest(text, pos)
            token = next(ahead)[1]
        if len(table) > COMPATIBLE_PAIRS:
            table.clear()
        coded = self.coded
        return b"".join([coded[t] for t in out])

    def pretokens(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of the pre-tokens in normalised UTF-8 bytes that end in white space and 16 more bytes.

        The split pattern as classes: runs of letters, single numerals, runs of
        anything else but white space. An apostrophe that begins such a run and
        one of the pattern's endings after it make one token.
        """
        kind = _ASCII_KIND[raw]
        wide = np.flatnonzero(raw >= 0xC0)  # first bytes of longer characters
        if len(wide):
            b0, more = raw[wide].astype(np.uint32), [raw[wide + k].astype(np.uint32) & 63 for k in (1, 2, 3)]
            two, three = (b0 & 31) << 6 | more[0], (b0 & 15) << 12 | more[0] << 6 | more[1]
            four = (b0 & 7) << 18 | more[0] << 12 | more[1] << 6 | more[2]
            point = np.where(b0 < 0xE0, two, np.where(b0 < 0xF0, three, four))
            found, at = np.unique(point, return_inverse=True)
            k = np.array([kind_of(chr(c)) for c in found.tolist()], np.uint8)[at]
            for i, least in enumerate((0, 0xC0, 0xE0, 0xF0)):
                kind[wide[b0 >= least] + i] = k[b0 >= least]
        first = np.ones(len(raw), bool)
        first[1:] = kind[1:] != kind[:-1]
        start = (first | ((kind == NUMERAL) & (raw & 0xC0 != 0x80))) & (kind != BLANK)
        mark = np.flatnonzero((raw == 0x27) & first)
        mark = mark[kind[mark + 1] == LETTER]
        if len(mark):
            pair = raw[mark + 1].astype(np.uint16) << 8 | raw[mark + 2]
            size = np.where(np.isin(raw[mark + 1], _ENDINGS_1), 2, np.where(np.isin(pair, _ENDINGS_2), 3, 0))
            mark, size = mark[size > 0], size[size > 0]
            start[mark + 1] = False
            past = mark + size
            start[past[kind[past] == LETTER]] = True
        edge = np.flatnonzero(start | (first & (kind == BLANK)))
        own = np.flatnonzero(start[edge])
        own = own[own + 1 < len(edge)]
        return edge[own], edge[own + 1]

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's ids end."""
        if not (self.cut and any("<|" in t for t in texts)):
            return self._plain(texts)
        parts = [self.cut(t) for t in texts]  # text, special token, text, ...
        ids, ends = self._plain([p for own in parts for p in own[::2]])
        done = iter(np.split(ids, ends[:-1]))
        out = [[np.array([self.spec.added[p]], "<u4") if i % 2 else next(done) for i, p in enumerate(own)] for own in parts]
        return np.concatenate([x for own in out for x in own]), np.cumsum([sum(map(len, own)) for own in out])

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`encode_many`, of texts without special tokens."""
        low = [t.lower() if t.isascii() else unicodedata.normalize("NFC", t).replace("Σ", "σ").lower() for t in texts]  # no final sigma
        low = [t.encode() for t in low]
        body = b"\n".join([*low, b"\0" * 16])
        raw = np.frombuffer(body, np.uint8)
        start, end = self.pretokens(raw)
        size = end - start
        # equal pre-tokens are found by their bytes: sixteen in two integers, or as they are
        eight = np.lib.stride_tricks.as_strided(raw[:8].view("<u8"), (len(raw) - 7,), (1,))
        a = eight[start] & _MASKS[np.minimum(size, 8)]
        b = eight[np.minimum(start + 8, len(raw) - 8)] & _MASKS[np.clip(size - 8, 0, 8)]
        with np.errstate(over="ignore"):
            h = (a ^ (b + size.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        _, rep, same = np.unique(h, return_index=True, return_inverse=True)
        head = rep[same]
        odd = np.flatnonzero((a != a[head]) | (b != b[head]) | (size != size[head]) | (size > 16))
        keys = [body[x:y] for x, y in zip(start[rep].tolist(), end[rep].tolist(), strict=True)]
        if len(odd):  # each on its own
            same[odd] = len(keys) + np.arange(len(odd))
            keys += [body[x:y] for x, y in zip(start[odd].tolist(), end[odd].tolist(), strict=True)]
        coded = self.words.all_of(keys, self.encode_word)
        blob = np.frombuffer(b"".join(coded), "<u4")
        n = np.fromiter(map(len, coded), np.int64, len(coded)) >> 2
        begin, many = (np.cumsum(n) - n)[same], n[same]
        past = np.cumsum(many)
        ids = blob[np.arange(past[-1] if len(past) else 0) + np.repeat(begin - (past - many), many)]
        ends = np.cumsum([len(t) + 1 for t in low])
        return ids, np.concatenate([[0], past])[np.searchsorted(start, ends)]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_many([text or ""])[0]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Token strings joined by one space, as UTF-8, gathered from the offset table."""
        if not len(ids):
            return b""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        where = np.arange(ends[-1]) + np.repeat(self.offsets[ids] - (ends - sizes), sizes)
        return self.blob[where].tobytes()[:-1]


def encoder(spec: Spec) -> Encoder:
    """The worker's encoder for this vocabulary (built on first use)."""
    return held("bpe " + spec.key, lambda: Encoder(spec))


def ship(spark: SparkSession, vocabulary: str):
    """Broadcast the vocabulary: its size is that of the file, whatever the corpus."""
    return spark.sparkContext.broadcast(load_spec(vocabulary))


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and the decoded text of every document.

    Returns ``id_col``, ``ids`` (array<int>) and ``decoded`` (string); a narrow
    stage without a shuffle. Other columns of ``docs`` are not read.
    """
    spec = ship(docs.sparkSession, vocabulary)

    def run(batches):
        enc = encoder(spec.value)
        for piece in slices_of(batches, 1, TEXT_BYTES):
            flat, ends = enc.encode_many([t or "" for t in piece.column(1).to_pylist()])
            ids = np.split(flat, ends[:-1])
            flat, ends = flat.astype(np.int32), np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array([enc.decode_bytes(x).decode() for x in ids], pa.string())],
                ["id", "ids", "decoded"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token count and SHA-256 digests of ids and decoded text, made in the same pass.

    The same encoder and decoder as :func:`encode_decode`; only the digests
    leave the Python worker, so texts are not sent back to the JVM.
    """
    spec = ship(docs.sparkSession, vocabulary)

    def run(batches):
        enc = encoder(spec.value)
        sha, decimal = hashlib.sha256, enc.decimal
        for piece in slices_of(batches, 1, TEXT_BYTES):
            n, a, b = [], [], []
            flat, ends = enc.encode_many([t or "" for t in piece.column(1).to_pylist()])
            for ids in np.split(flat, ends[:-1]):
                n.append(len(ids))
                a.append(sha(" ".join([decimal[i] for i in ids.tolist()]).encode()).hexdigest())
                b.append(sha(enc.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
