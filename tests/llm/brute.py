"""Plain versions of the operators, by the contract's words, for comparison."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = "\x20\x09-\x0d"
WORDS = re.compile(f"[^{SPACE}]+")


def lower(s: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def quality(text):
    t = text or ""
    w = WORDS.findall(t)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if grams[(w[i], w[i + 1], w[i + 2])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed,
    )


def line_dedup(docs, min_docs=10, min_chars=1, keep_first=False):
    """docs: (id, text); id -> (n_lines, n_dropped, sha) in input order."""
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    seen, first = Counter(), {}
    for d, t in docs:
        lines = (t or "").split("\n")
        for k in {key(x) for x in lines}:
            seen[k] += 1
        for n, x in enumerate(lines):
            first[key(x)] = min(first.get(key(x), (d, n)), (d, n))
    bad = {k for k, n in seen.items() if n >= min_docs and len(k) >= min_chars}
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for n, x in enumerate(lines) if key(x) not in bad or (keep_first and first[key(x)] == (d, n))]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def fingerprint(text):
    w = WORDS.findall(lower(text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps: dict[int, int], distance=2):
    """id -> component id (smallest reachable) from id -> fingerprint."""
    by = defaultdict(list)
    for d, f in fps.items():
        by[f].append(d)
    keys = np.array(sorted(by), np.uint64)
    parent = {int(k): int(k) for k in keys}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, k in enumerate(keys):
        for j in np.flatnonzero(np.bitwise_count(keys[i + 1 :] ^ k) <= distance):
            parent[find(int(keys[i + 1 + j]))] = find(int(k))
    least = {}
    for f, ds in by.items():
        r = find(f)
        least[r] = min([least.get(r, min(ds)), *ds])
    return {d: least[find(f)] for d, f in fps.items()}


def shingles(text, k=5):
    w = WORDS.findall(lower(text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def mix(docs, share=1.5, ceiling=2.0, weights=(3, 1, 2)):
    """docs: (id, source, text); id -> (size, source_size, target, taken)."""
    size = {d: len(WORDS.findall(t or "")) for d, _, t in docs}
    src = {d: s for d, s, _ in docs}
    names = sorted({s for s in src.values() if s is not None}) + ([None] if None in src.values() else [])
    total = {s: sum(size[d] for d in src if src[d] == s) for s in names}
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        rest = share * sum(total.values()) - sum(ceiling * total[s] for s in capped)
        live = [s for s in names if s not in capped]
        sw = sum(w[s] for s in live)
        target = {s: ceiling * total[s] if s in capped else rest / sw * w[s] for s in names}
        over = {s for s in live if target[s] > ceiling * total[s]}
        if not over:
            break
        capped |= over
    out = {}
    for s in names:
        ids = sorted((d for d in src if src[d] == s), key=lambda d: (hashlib.md5(f"mix:{d}".encode()).hexdigest(), d))
        at, limit = 0, int(target[s])
        passes, over = divmod(limit, total[s]) if total[s] else (0, 0)
        for d in ids:
            out[d] = (size[d], total[s], target[s], passes * size[d] + max(0, min(size[d], over - at)))
            at += size[d]
    return out


def pieces(docs, tokenizer, capacity=4096, end=1):
    """(id, piece) -> (start, length, crc)."""
    out = {}
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out[d, k] = (at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    return out


def suffix_dedup(docs, length=200):
    """docs: (id, text); id -> (n_bytes, n_removed, n_spans, sha)."""
    count = Counter()
    for _, t in docs:
        b = (t or "").encode()
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = {}
    for d, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length - len(b) - 1 if i + length > len(b) else i + length] -= 1
        mask = np.cumsum(gone[: len(b)]) > 0
        edges = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
        kept = bytes(np.frombuffer(b, np.uint8)[~mask])
        out[d] = (len(b), int(mask.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def top_scores(vectors, queries, k=10):
    """vectors: id -> list of floats; per query the k best (id, score)."""
    import math

    ints = {i: [math.floor(1024 * float(x)) for x in v] for i, v in vectors.items()}
    out = {}
    for q in queries:
        scored = sorted(((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q))
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out
