"""Front-coded sorted runs of byte strings and a loser tree that merges them by common prefixes."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

_HEAD = struct.Struct("<HHHH")


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of ``a`` and ``b``, known to be ``start`` or more."""
    end = min(len(a), len(b))
    if a[start:end] == b[start:end]:
        return end
    differ = int.from_bytes(a[start:end], "big") ^ int.from_bytes(b[start:end], "big")
    return end - (differ.bit_length() + 7) // 8


def front_coded(entries: Iterable[tuple[bytes, bytes]]) -> bytes:
    """A run: (key, payload) in ascending order of keys; each key keeps only what follows its common prefix with the last."""
    out, last = [], b""
    for key, payload in entries:
        shared = common(last, key)
        out += (_HEAD.pack(shared, len(key) - shared, len(payload), 0), key[shared:], payload)
        last = key
    return b"".join(out)


def decoded(run: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    """(common prefix with the key before, key, payload) of each entry."""
    at, key, unpack, size = 0, b"", _HEAD.unpack_from, _HEAD.size
    while at < len(run):
        shared, rest, extra, _ = unpack(run, at)
        at += size
        key = key[:shared] + run[at : at + rest]
        at += rest
        yield shared, key, run[at : at + extra]
        at += extra


def merged(runs: list[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
    """All entries of all runs in order of keys, each with its common prefix with the entry before.

    A loser tree: a waiting head remembers its common prefix with the last key that went
    past it. Of two heads the one with the longer prefix is smaller, unseen; only heads
    with equal prefixes are compared, from that prefix on, so no known byte is read twice.
    """
    size = 1
    while size < len(runs):
        size *= 2
    streams = [decoded(r) for r in runs]
    # the head of a run: [prefix with the last winner, key, payload], None at its end
    heads: list = [next(s, None) for s in streams] + [None] * (size - len(runs))
    heads = [None if h is None else [0, h[1], h[2]] for h in heads]
    losers = [0] * size

    def smaller(i: int, j: int) -> tuple[int, int]:
        """(winner, loser) of two runs' heads."""
        a, b = heads[i], heads[j]
        if a is None:
            return j, i
        if b is None:
            return i, j
        if a[0] != b[0]:
            return (i, j) if a[0] > b[0] else (j, i)
        x, y = a[1], b[1]
        n = common(x, y, a[0])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            b[0] = n
            return i, j
        a[0] = n
        return j, i

    def build(node: int) -> int:
        if node >= size:
            return node - size
        winner, losers[node] = smaller(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if size > 1 else 0
    while heads[winner] is not None:
        head = heads[winner]
        yield head[0], head[1], head[2]
        following = next(streams[winner], None)
        heads[winner] = None if following is None else list(following)
        node = (winner + size) // 2
        while node:
            winner, losers[node] = smaller(winner, losers[node])
            node //= 2
