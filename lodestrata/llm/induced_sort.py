"""Induced sorting of a shard's suffixes, in vectorised rounds.

The suffix array of a byte string is built as in induced sorting: suffixes are
of type S or L; the leftmost S ones (LMS) are sorted first, their repeated names
ordered by doubling, as deep as the length asked for; then one sweep over rising
first bytes induces the L suffixes and one over falling first bytes the S
suffixes. The sweeps take their work from a bucket priority queue: tuples wait
under the byte they start with, in the order in which they came. A shard lies in
memory; only tuples beyond ``memory`` bytes that wait go to a scratch file, which
the queue's owner removes when the task ends.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Bytes of waiting tuples that a queue keeps in memory.
QUEUE_MEMORY = 64 << 20


class BucketQueue:
    """Priority queue over small integer keys; equal keys leave in the order they came."""

    def __init__(self, keys: int, memory: int = QUEUE_MEMORY):
        self.waiting: list[list] = [[] for _ in range(keys)]
        self.memory, self.held, self.file = memory, 0, None

    def push(self, keys: np.ndarray, values: np.ndarray) -> None:
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for k, part in zip(keys[starts].tolist(), np.split(values, cuts), strict=True):
            self.waiting[k].append(part)
        self.held += values.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()  # has no name; gone with its handle
        self.file.seek(0, 2)
        for parts in self.waiting:
            for i, p in enumerate(parts):
                if isinstance(p, np.ndarray):
                    parts[i] = (self.file.tell(), len(p), p.dtype)
                    self.file.write(p.tobytes())
        self.held = 0

    def pop(self, key: int) -> np.ndarray:
        parts, self.waiting[key] = self.waiting[key], []
        out = []
        for p in parts:
            if isinstance(p, tuple):
                self.file.seek(p[0])
                p = np.frombuffer(self.file.read(p[1] * p[2].itemsize), p[2])
            else:
                self.held -= p.nbytes
            out.append(p)
        return np.concatenate(out) if out else np.empty(0, np.int32)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it (type S)."""
    n = len(t)
    change = np.flatnonzero(t[1:] != t[:-1])  # last places of runs of equal symbols
    s = np.zeros(n, bool)
    if len(change):
        rises = t[change] < t[change + 1]
        lengths = np.diff(np.concatenate([[-1], change]))
        s[: change[-1] + 1] = np.repeat(rises, lengths)
    s[n - 1] = True  # the end mark
    return s


def induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray, keys: int) -> np.ndarray:
    """All suffixes in order, given the LMS suffixes in order of what is known of them."""
    seeds = BucketQueue(keys)
    seeds.push(t[lms], lms)
    queue = BucketQueue(keys)
    larger: list[np.ndarray] = []
    for c in range(keys):  # L suffixes, from small to large
        batch, mine = queue.pop(c), []
        while len(batch):
            mine.append(batch)
            before = batch[batch > 0] - 1
            before = before[~s[before]]
            k = t[before]
            queue.push(k[k > c], before[k > c])
            batch = before[k == c]
        seed = seeds.pop(c)
        before = seed[seed > 0] - 1
        before = before[~s[before]]
        queue.push(t[before], before)
        larger.append(np.concatenate(mine) if mine else np.empty(0, np.int32))
    queue.close()
    seeds.close()
    queue = BucketQueue(keys)
    out: list[np.ndarray] = []
    for c in range(keys - 1, -1, -1):  # S suffixes, from large to small
        batch, mine = queue.pop(c), []
        while len(batch):
            mine.append(batch)
            before = batch[batch > 0] - 1
            before = before[s[before]]
            k = t[before]
            queue.push(k[k < c], before[k < c])
            batch = before[k == c]
        own = larger[c][::-1]
        before = own[own > 0] - 1
        before = before[s[before]]
        queue.push(t[before], before)
        if c == 0 and not mine:
            mine = [np.array([len(t) - 1], np.int32)]  # the end mark
        out.append(own)
        out += [] if not mine else [np.concatenate(mine)]
        # within a bucket S suffixes come after the L ones: falling order lists them first
        if mine:
            out[-1], out[-2] = out[-2], out[-1]
    queue.close()
    return np.concatenate(out)[::-1]


def order_of_names(names: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Order of all suffixes of a string of names, by doubling what is compared.

    A rank is the place at which a suffix's group begins; groups of one are
    settled and not looked at again. depth: compare at least so many names only.
    """
    n = len(names)
    count = np.bincount(names)
    rank = (np.cumsum(count) - count)[names]
    live = np.flatnonzero(count[names] > 1)
    width, most = 1, n if depth is None else min(n, depth)
    while len(live) and width < most:
        after = live + width
        key = rank[live] * np.int64(n + 2)
        inside = after < n
        key[inside] += rank[after[inside]] + 1
        by = np.argsort(key)
        live, key = live[by], key[by]
        new = np.ones(len(live), bool)
        new[1:] = key[1:] != key[:-1]
        old = rank[live]
        head = np.ones(len(live), bool)
        head[1:] = old[1:] != old[:-1]
        at = np.arange(len(live))
        part = np.maximum.accumulate(np.where(new, at, 0))
        rank[live] = old + part - np.maximum.accumulate(np.where(head, at, 0))
        alone = new.copy()
        alone[:-1] &= new[1:]
        live = live[~alone]
        width *= 2
    return np.argsort(rank, kind="stable")


def suffix_array(data: bytes | np.ndarray, depth: int | None = None) -> np.ndarray:
    """Start places of all suffixes of ``data`` in order (by their first ``depth`` bytes at least, if given)."""
    raw = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    n = len(raw)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    t = np.zeros(n + 1, np.uint16)
    t[:n] = raw
    t[:n] += 1
    s = types(t)
    is_lms = np.zeros(n + 1, bool)
    is_lms[1:] = s[1:] & ~s[:-1]
    lms = np.flatnonzero(is_lms).astype(np.int32)
    if len(lms) > 1:
        rough = induce(t, s, lms, 257)
        rough = rough[is_lms[rough]]  # LMS substrings in order
        ends = np.append(lms[1:], n)  # each reaches to the next LMS place
        place = np.empty(n + 1, np.int32)
        place[lms] = np.arange(len(lms), dtype=np.int32)
        start, size = rough, ends[place[rough]] - rough + 1
        same = np.zeros(len(rough), bool)
        same[1:] = size[1:] == size[:-1]
        same[1:] &= rough[:-1] != n
        same[0] = False
        for step in range(int(size.max())):  # compare neighbours symbol by symbol, while some are still equal
            todo = np.flatnonzero(same & (size > step))
            if not len(todo):
                break
            a, b = start[todo] + step, start[todo - 1] + step
            same[todo] &= (t[a] == t[b]) & (s[a] == s[b])
        names = np.empty(len(lms), np.int64)
        names[place[rough]] = np.cumsum(~same) - 1
        # a name spans two bytes at least
        lms = lms[order_of_names(names, depth and depth // 2 + 1)] if names.max() + 1 < len(lms) else rough
    return induce(t, s, lms, 257)[1:]  # without the end mark


def as_before(raw: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix in ``order`` begins with the same ``length`` bytes as the one before it.

    Every suffix in ``order`` has to have that many bytes.
    """
    out = np.zeros(len(order), bool)
    if len(order) < 2:
        return out
    heads = np.lib.stride_tricks.as_strided(raw[:length].view(f"V{length}"), (len(raw) - length + 1,), (1,))
    for lo in range(1, len(order), 1 << 14):
        here = heads[order[lo - 1 : lo + (1 << 14)]]
        out[lo : lo + (1 << 14)] = here[1:] == here[:-1]
    return out
