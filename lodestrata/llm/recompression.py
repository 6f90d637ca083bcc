"""Locally consistent parsing of token sequences by recompression.

A round names maximal runs of equal symbols, then splits the alphabet by one
bit of the names and names each adjacent pair (left symbol, right symbol).
Names are 64-bit hashes of what they stand for, so they are global without
coordination: equal substrings get equal symbols in their interior, wherever they
occur. With each symbol goes the token interval (its *context*) on which its
existence depends; whoever sees the whole context sees the symbol.
"""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
ROUNDS = 2
_POWER = U(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def parse(tokens: np.ndarray, rounds: int = ROUNDS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each level (tokens first), the new symbols: (names, context starts, context ends).

    tokens: hashes. Contexts that would need a token before the first or after
    the last one start at -1 or end at len + 1, so that no window holds them.
    """
    n = len(tokens)
    name, start, end = tokens, np.arange(n), np.arange(1, n + 1)
    levels = [(name, start, end)]
    for level in range(1, rounds + 1):
        if len(name) < 2:
            break
        # runs: whether a symbol is a run (or alone) shows in its neighbours
        first = np.empty(len(name), bool)
        first[0] = True
        np.not_equal(name[1:], name[:-1], out=first[1:])
        at = np.flatnonzero(first)
        last = np.append(at[1:], len(name)) - 1
        length = last - at + 1
        run = length > 1
        run_name = name[at].copy()
        run_name[run] = mixed(name[at][run] * U(0xD6E8FEB86659FD93) + length[run].astype(U) * U(2 * level + 1))
        lo = np.where(at > 0, start[at - 1], -1)
        hi = np.where(last + 1 < len(name), end[np.minimum(last + 1, len(name) - 1)], n + 1)
        # pairs: a left symbol and the right symbol after it
        side = (mixed(run_name + U(level)) & U(1)).astype(bool)  # True: right
        pair = np.zeros(len(at), bool)
        pair[:-1] = ~side[:-1] & side[1:]
        second = np.zeros(len(at), bool)
        second[1:] = pair[:-1]
        head = np.flatnonzero(pair)
        pair_name = mixed(run_name[head] * U(0xA0761D6478BD642F) + mixed(run_name[head + 1] + U(level << 8)))
        new = [(pair_name, lo[head], hi[head + 1])]
        if run.any():
            alone = np.flatnonzero(run)
            new.append((run_name[alone], lo[alone], hi[alone]))
        levels.append(tuple(np.concatenate(x) for x in zip(*new, strict=True)))
        # the next round's symbols; one left alone depends on the neighbour it did not pair with
        nxt_hi = np.append(hi[1:], n + 1)
        prev_lo = np.insert(lo[:-1], 0, -1)
        s = np.where(side & ~second, prev_lo, lo)
        e = np.where(~side & ~pair, nxt_hi, hi)
        nm = run_name.copy()
        nm[head] = pair_name
        e[head] = hi[head + 1]
        keep = ~second
        name, start, end = nm[keep], s[keep], e[keep]
    return levels


def anchors(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], prefix: np.ndarray, window: int) -> np.ndarray:
    """For each window start of a parse, the name of what stands for the window.

    That is the top symbol of largest rank whose context the window holds, if
    the context has more than two thirds of the window's tokens; a window without
    such a symbol takes the run of so many tokens with the largest rank. Either
    way the choice depends on the window's tokens alone, so equal windows agree,
    and neighbours mostly do.
    """
    n = len(prefix) - 1
    m, least = n - window + 1, 2 * window // 3 + 1
    name, start, end = levels[-1]
    ok = (start >= 0) & (end - start <= window) & (end - start >= least) & (end <= n)
    at = start[ok]
    rank = np.zeros(n + 1, U)  # contexts of one level start at different places
    rank[at] = mixed(name[ok] + U(len(levels))) | U(1)
    slack = np.full(n + 1, -1, np.int8)
    slack[at] = window - (end[ok] - at)
    best = np.zeros(m, U)
    for d in range(window - least + 1):
        np.maximum(best, np.where(slack[d : d + m] >= d, rank[d : d + m], U(0)), out=best)
    rest = np.flatnonzero(best == 0)
    if len(rest):
        p = np.arange(n - least + 1)
        runs = interval_hashes(prefix, p, p + least) | U(1)
        got = runs[rest]
        for d in range(1, window - least + 1):
            np.maximum(got, runs[rest + d], out=got)
        best[rest] = got
    return best


def cuts(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], limit: np.ndarray, one_in: int) -> np.ndarray:
    """Places where the coarsest round cuts: starts of those top symbols whose name says so.

    limit: for each token, the end of its text. A context that runs over the end
    of its text (as that of a run of equal last words does) cuts nothing. So a cut
    depends on its symbol's context, a part of one text, alone: equal stretches are
    cut alike, whatever is parsed beside them.
    """
    name, start, end = levels[-1]
    ok = (start >= 0) & (end <= limit[start]) & (mixed(name + U(0xC0FFEE)) % U(one_in) == 0)
    return np.unique(start[ok])


def prefix_hashes(tokens: np.ndarray) -> np.ndarray:
    """h[i]: polynomial hash of the first i tokens, each weighted by its place."""
    w = powers(len(tokens))
    out = np.zeros(len(tokens) + 1, U)
    np.cumsum(tokens * w, out=out[1:])
    return out


_POWERS = [np.ones(1, U)]


def powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        size = max(n, 4096)
        p = np.full(size, _POWER, U)
        p[0] = U(1)
        _POWERS[0] = np.cumprod(p)
    return _POWERS[0][:n]


_INVERSE = [np.ones(1, U)]
_INV = U(pow(int(_POWER), -1, 1 << 64))


def interval_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of tokens[start:end], the same wherever it stands."""
    n = len(prefix)
    if len(_INVERSE[0]) < n:
        p = np.full(max(n, 4096), _INV, U)
        p[0] = U(1)
        _INVERSE[0] = np.cumprod(p)
    return mixed((prefix[end] - prefix[start]) * _INVERSE[0][start] + (end - start).astype(U))


#: Words of more bytes are hashed one by one.
LONG_WORD = 256
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], U)


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, eight bytes a step; ``raw`` has eight bytes more after the last range."""
    size = end - start
    out = mixed(size.astype(U) * _POWER)
    if not len(start):
        return out
    eight = np.lib.stride_tricks.as_strided(raw[:8].view("<u8"), (len(raw) - 7,), (1,))
    long = np.flatnonzero(size > LONG_WORD)
    for i in long.tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[start[i] : end[i]], digest_size=8).digest(), "little")
    todo, at = np.flatnonzero(size <= LONG_WORD), 0
    while len(todo):
        block = eight[start[todo] + at] & _MASKS[np.minimum(size[todo] - at, 8)]
        out[todo] = mixed((out[todo] ^ block) * _POWER + U(1))
        at += 8
        todo = todo[size[todo] > at]
    return out


# Primes below 2^31, and the bases that powers are taken of.
_FIELDS = ((2147483629, 1103515249, 0), (2147483587, 1566083941, 33))


def _power_table(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, U)
    while len(out) < n:
        out = np.concatenate([out, out * U(pow(base, len(out), prime)) % U(prime)])
    return out


class FieldHashes:
    """A second hash of token intervals, by polynomials over two prime fields.

    Independent of :func:`interval_hashes`: who agrees in both has 125 bits in common.
    """

    _tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, tokens: np.ndarray):
        self.parts = []
        for prime, base, shift in _FIELDS:
            up, down = self._tables.get(prime, ((), ()))
            if len(up) <= len(tokens):
                n = max(4096, 2 * len(tokens))
                up, down = self._tables[prime] = _power_table(base, prime, n), _power_table(pow(base, -1, prime), prime, n)
            prefix = np.zeros(len(tokens) + 1, U)
            np.cumsum((tokens >> U(shift)) % U(prime) * up[: len(tokens)] % U(prime), out=prefix[1:])
            self.parts.append((U(prime), prefix, down))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        a, b = ((prefix[end] - prefix[start]) % prime * down[start] % prime for prime, prefix, down in self.parts)
        return a << U(31) | b
