"""Removal of repeated byte strings by a sparse suffix array in distributed, prefix-aware merge sort.

Every byte covered by a string of ``length`` bytes that starts anywhere else too goes.

Anchors. A string of ``length`` bytes has an anchor: the first of its ``gram``-byte
strings with the smallest hash. Equal strings have their anchors at the same place, so
suffixes need sorting at anchors alone (one in about ``(length - gram) / 2`` bytes), and
only where the anchor's gram occurs twice (its hash is counted first; a hash shared by
chance only brings an anchor too many).

Merge sort. Splitters from a sample cut the order of (suffix, context before the anchor) into
ranges of about equal size, so that the occurrences of one frequent gram, or of one frequent
suffix, are spread over tasks. A task sorts its anchors' suffixes, adds up equal ones, and sends front-coded
sorted runs to the ranges. There a loser tree merges the runs; it gives the
common prefix of neighbours without comparing known prefixes again.

Verdict. A string that starts d bytes before its anchor is repeated if another suffix
agrees on ``length - d`` bytes after the anchor (a class of the sorted suffixes, from
their common prefixes) and on the d bytes before it (a class of the sorted reversed
contexts). Inside a range both classes are compared byte by byte. A class that a splitter may
cut, because it agrees with its suffix so far, also hands its string's 128-bit digest to one count over all ranges.

Digests stand for strings in joins: 128 bits of XXH3 for contexts and strings, 128 bits of SHA-256 for
texts. Equal texts are one with a count, so copies meet before anything is sorted.

Defined results: a null text is empty; texts shorter than ``length`` bytes keep everything;
null ids are carried through; repeated rows are copies of each other; an empty table
gives an empty result. What is kept may end inside a character, so it is bytes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, text_or_empty, written
from .lcp_merge import common, front_coded, merged

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(0, 1 << 64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: A task sends a run when it holds so many suffixes.
RUN_ENTRIES = 40_000
#: Anchors' hashes are added up in a task before so many are sent.
HELD = 1_000_000
#: The sample has about so many suffixes for each range, from one text in so many (from all, where these give too few).
SAMPLE_EACH, SAMPLE_TEXTS = 8, 8


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each ``gram``-byte string: a function of its bytes alone."""
    n = len(data)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    h = (sums[gram:] - sums[: n - gram + 1]) * down[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def anchors(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, gram hash, first start, last start) of each anchor; the starts are those of the strings it belongs to."""
    width = length - gram + 1
    if width > 256:
        raise ValueError("length - gram must be 255 at most")
    if len(text) < length:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none, none
    h = gram_hashes(np.frombuffer(text, np.uint8), gram)
    # minimum over `width` neighbours from block-wise running minima; the lowest 8 bits hold the place in the block
    blocks = -(-len(h) // width)
    key = np.full(blocks * width, np.uint64((1 << 64) - 1))
    key[: len(h)] = h & np.uint64((1 << 64) - 256)
    key = key.reshape(blocks, width) | np.arange(width, dtype=np.uint64)
    forward = np.minimum.accumulate(key, axis=1).ravel()
    backward = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(len(text) - length + 1)
    left, right = backward[starts], forward[starts + width - 1]
    here = (left >> np.uint64(8)) <= (right >> np.uint64(8))
    place = (np.where(here, left, right) & np.uint64(255)).astype(np.int64)
    at = np.where(here, starts, starts + width - 1) // width * width + place
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return at[first], h[at[first]], first, last


def _repeated_grams(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """h of the anchors' grams whose hash occurs twice or more; a task adds up its own before sending."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n > 1)], ["h", "twice"])

        for batch in sliced(batches):
            for body in batch.column("body").cast(pa.binary()).to_pylist():
                h = anchors(body, length, gram)[1]
                held.append(h)
                size += len(h)
            if size >= HELD:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    seen = texts.mapInArrow(count, "h long, twice boolean").groupBy("h")
    return seen.agg(F.count("*").alias("n"), F.max("twice").alias("twice")).where("n > 1 or twice").select("h")


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """h, short (64 bits of the text's key), at of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for short, body in zip(batch.column("short").to_pylist(), batch.column("body").cast(pa.binary()).to_pylist(), strict=True):
                at, h, _, _ = anchors(body, length, gram)
                out.append((h.view(np.int64), np.full(len(at), short, np.int64), at.astype(np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["h", "short", "at"])

    return texts.mapInArrow(run, "h long, short long, at int")


def _contexts(body: bytes, wanted: list[int], length: int, gram: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(anchor, hash, suffix, payload) of the wanted anchors.

    The suffix is as long as the strings of the anchor reach; the payload is the smallest and
    the largest distance of a start before the anchor, then the bytes before it, nearest first.
    """
    at, h, first, last = anchors(body, length, gram)
    keep = np.isin(at, np.asarray(wanted, np.int64))
    for a, g, lo, hi in zip(at[keep].tolist(), h[keep].tolist(), first[keep].tolist(), last[keep].tolist(), strict=True):
        yield a, g, body[a : hi + length], bytes((a - hi, a - lo)) + body[lo:a][::-1]


def _digest(suffix: bytes, payload: bytes) -> bytes:
    return xxhash.xxh3_128_digest(len(suffix).to_bytes(4, "little") + suffix + payload)


Splitters = list[tuple[bytes, bytes]]


def _splitters(joined: DataFrame, ranges: int, length: int, gram: int) -> Splitters:
    """At most ``ranges`` - 1 splitters (suffix, payload) from a sample: they decide where the work is done, not its result.

    A task gives its share of the sample, the suffixes with the smallest hashes, so that the driver gets ``SAMPLE_EACH`` for
    each range, or one for each task, at any input.
    """
    most = SAMPLE_EACH * ranges
    share = max(1, -(-most // joined.rdd.getNumPartitions()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[bytes, bytes]] = {}

        def least() -> None:
            for h in sorted(held)[share:]:
                del held[h]

        for batch in sliced(batches):
            for body, wanted in zip(batch.column("body").cast(pa.binary()).to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                for at, _, suffix, payload in _contexts(body, wanted, length, gram):
                    held[xxhash.xxh3_64_intdigest(payload + suffix + at.to_bytes(8, "little")) >> 1] = suffix, payload
            if len(held) > 4 * share:
                least()
        least()
        keys = list(held.values())
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.binary()) for i in (0, 1)], ["suffix", "payload"])

    def sampled(texts: DataFrame) -> Splitters:
        rows = texts.select("body", "wanted").mapInArrow(run, "suffix binary, payload binary")
        return sorted((bytes(r.suffix), bytes(r.payload)) for r in rows.collect())

    keys = sampled(joined.where(F.pmod(F.xxhash64("key"), F.lit(SAMPLE_TEXTS)) == 0))
    if len(keys) < most // 2:
        keys = sampled(joined)
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def _runs(joined: DataFrame, splitters: Splitters, length: int, gram: int) -> DataFrame:
    """part, run: front-coded sorted runs; the payload's first byte is 2 for what a task has twice or more, else 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bytes, bytes], int] = {}

        def flush() -> pa.RecordBatch:
            keys = sorted(held)
            ends = [bisect_left(keys, s) for s in splitters] + [len(keys)]
            out = {}
            for part, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
                if a < b:
                    out[part] = front_coded((k[0], bytes((min(held[k], 2),)) + k[1]) for k in keys[a:b])
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array(list(out.values()), pa.binary())], ["part", "run"])

        for batch in sliced(batches):
            columns = (batch.column(c) for c in ("body", "copies", "wanted"))
            for body, copies, wanted in zip(*[c.cast(pa.binary()).to_pylist() if c.type == pa.string() else c.to_pylist() for c in columns], strict=True):
                for _, _, suffix, payload in _contexts(body, wanted, length, gram):
                    key = suffix, payload
                    held[key] = held.get(key, 0) + copies
                if len(held) >= RUN_ENTRIES:
                    yield flush()
        if held:
            yield flush()

    return joined.select("body", "copies", "wanted").mapInArrow(run, "part int, run binary")


def _neighbours(rows: list[bytes], width: int) -> np.ndarray:
    """Common prefix of each of the sorted rows with the row before (0 for the first)."""
    out = np.zeros(len(rows), np.int64)
    for i in range(1, len(rows), 4096):  # in blocks, so that the matrices stay small
        part = rows[i - 1 : i + 4096]
        sizes = np.array([len(r) for r in part])
        block = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in part), np.uint8).reshape(-1, width)
        same = block[1:] == block[:-1]
        prefix = np.where(same.all(axis=1), width, same.argmin(axis=1))
        out[i : i + len(part) - 1] = np.minimum(prefix, np.minimum(sizes[1:], sizes[:-1]))
    return out


class Verdicts:
    """Of one range: ``decided``, (digest of a context, bit d set: the string that starts d bytes before the anchor is repeated), and
    ``cut``, (string's digest, 1 or 2 for more, context's digest, d) of classes that may go on in other ranges."""

    def __init__(self) -> None:
        self.decided: list[tuple[bytes, bytes]] = []
        self.cut: list[tuple[bytes, int, bytes, int]] = []


def verdicts(runs: list[bytes], length: int, gram: int, low_end: bytes | None = None, high_end: bytes | None = None) -> Verdicts:
    """The verdicts of a range's runs; ``low_end`` and ``high_end`` are the suffixes of the splitters around it."""
    width = length - gram + 1
    entries: list[list] = []  # [suffix, payload, times], neighbours in order of suffixes
    shared: list[int] = []
    here: dict[bytes, int] = {}
    previous = b""
    for prefix, suffix, payload in merged(runs):
        if suffix != previous:
            here.clear()
        previous = suffix
        times, rest = payload[0], payload[1:]
        if rest in here:
            entries[here[rest]][2] += times
        else:
            here[rest] = len(entries)
            entries.append([suffix, rest, times])
            shared.append(prefix)
    out = Verdicts()
    if not entries:
        return out
    low = np.array([e[1][0] for e in entries])
    high = np.array([e[1][1] for e in entries])
    twice = np.array([e[2] > 1 for e in entries])
    after = np.array(shared)
    # how far each suffix agrees with a splitter: what agrees there may agree with suffixes beyond it
    agreed = np.zeros(len(entries), np.int64)
    if low_end is not None:
        agreed = np.minimum.accumulate(np.concatenate([[common(low_end, entries[0][0])], after[1:]]))
    if high_end is not None:
        back_to_front = np.concatenate([[common(high_end, entries[-1][0])], after[:0:-1]])
        agreed = np.maximum(agreed, np.minimum.accumulate(back_to_front)[::-1])
    backs = [e[1][2:] for e in entries]
    order = sorted(range(len(backs)), key=backs.__getitem__)
    before = _neighbours([backs[i] for i in order], width)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    masks = np.zeros((len(entries), -(-width // 8) * 8), np.uint8)
    for d in range(width):
        inside = np.flatnonzero((low <= d) & (d <= high))
        if not len(inside):
            continue
        suffix_class = np.cumsum(after < length - d)[inside]
        back_class = np.cumsum(before < d)[place[inside]]
        _, first, group, size = np.unique(suffix_class * (len(entries) + 1) + back_class, return_index=True, return_inverse=True, return_counts=True)
        more = (size > 1) | twice[inside[first]]
        masks[inside, d] = more[group]
        for g in np.flatnonzero(agreed[inside[first]] >= length - d).tolist():
            e = entries[inside[first[g]]]
            string = xxhash.xxh3_128_digest(e[1][2 : 2 + d][::-1] + e[0][: length - d])
            out.cut.append((string, 1 + int(more[g]), _digest(e[0], e[1]), d))
    packed = np.packbits(masks, axis=1)
    out.decided = [(_digest(entries[i][0], entries[i][1]), packed[i].tobytes()) for i in np.flatnonzero(packed.any(axis=1))]
    return out


def _verdict_rows(runs: DataFrame, splitters: Splitters, length: int, gram: int) -> DataFrame:
    """digest, mask of every context with a repeated string."""
    ends = [None, *[s for s, _ in splitters], None]
    bytes_ = -(-(length - gram + 1) // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(part: int, found: list) -> pa.RecordBatch:
            v = verdicts(found, length, gram, ends[part], ends[part + 1])
            one = lambda d: (1 << (8 * bytes_ - 1 - d)).to_bytes(bytes_, "big")
            rows = [(a, m, None, None) for a, m in v.decided] + [(a, one(d), s, n) for s, n, a, d in v.cut]
            kinds = (pa.binary(), pa.binary(), pa.binary(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["digest", "mask", "string", "n"])

        part, found = None, []
        for batch in batches:
            for p, r in zip(batch.column("part").to_pylist(), batch.column("run").to_pylist(), strict=True):
                if p != part and found:
                    yield done(part, found)
                    found = []
                part = p
                found.append(r)
        if found:
            yield done(part, found)

    dealt = runs.repartition(len(splitters) + 1, "part").sortWithinPartitions("part")
    made = written(dealt.mapInArrow(run, "digest binary, mask binary, string binary, n int"), "suffix-verdicts")
    cut = made.where("string is not null")
    repeated = cut.groupBy("string").agg(F.sum("n").alias("n")).where("n > 1").select("string")
    joined = cut.where("n = 1").join(repeated, "string", "left_semi")
    return made.where("string is null").select("digest", "mask").unionAll(joined.select("digest", "mask"))


def _occurrences(joined: DataFrame, length: int, gram: int) -> DataFrame:
    """key, at, digest of every suspected anchor of every distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = [
                (key, a, _digest(suffix, payload))
                for key, body, wanted in zip(
                    batch.column("key").to_pylist(), batch.column("body").cast(pa.binary()).to_pylist(), batch.column("wanted").to_pylist(), strict=True
                )
                for a, _, suffix, payload in _contexts(body, wanted, length, gram)
            ]
            kinds = (pa.binary(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["key", "at", "digest"])

    return joined.select("key", "body", "wanted").mapInArrow(run, "key binary, at int, digest binary")


def cut(body: bytes, found: list[dict], length: int) -> tuple[bytes, int, int]:
    """(bytes that stay, number removed, number of removed runs); found: anchors with their masks."""
    edges = np.zeros(len(body) + 1, np.int64)
    for x in found:
        starts = x["at"] - np.flatnonzero(np.unpackbits(np.frombuffer(x["mask"], np.uint8)))
        edges[starts] += 1
        edges[starts + length] -= 1
    gone = np.cumsum(edges)[:-1] > 0
    kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
    return kept, int(gone.sum()), int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))


def repeated_strings(docs: DataFrame, text: str = "text", length: int = 200, gram: int = 64) -> DataFrame:
    """key, kept (bytes), n_removed, n_spans of every distinct text that loses something.

    key: the first 16 bytes of the text's SHA-256, as ``text_key`` gives it.
    """
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    long = docs.select(text_or_empty(text).alias("body")).where(F.octet_length("body") >= length)
    keyed = long.select("body", text_key(F.col("body")).alias("key"))
    short = F.conv(F.hex(F.substring("key", 1, 7)), 16, 10).cast("long")  # 56 bits
    grams = written(_repeated_grams(long, length, gram), "suffix-grams")
    rows = _anchor_rows(keyed.select("body", short.alias("short")), length, gram)
    hits = rows.join(grams, "h", "left_semi").groupBy("short").agg(F.collect_set("at").alias("wanted"))
    keys = keyed.select("key").distinct().withColumn("short", short)
    wanted = keys.join(hits, "short").select("key", "wanted")
    distinct = keyed.groupBy("key").agg(F.first("body").alias("body"), F.count("*").alias("copies"))
    joined = distinct.join(wanted, "key").select("key", "body", F.least("copies", F.lit(2)).alias("copies"), "wanted")
    joined = written(joined, "suffix-texts")

    splitters = _splitters(joined, parts, length, gram)
    masks = _verdict_rows(_runs(joined, splitters, length, gram), splitters, length, gram)
    spots = _occurrences(joined, length, gram).join(masks, "digest")
    found = spots.groupBy("key").agg(F.collect_list(F.struct("at", "mask")).alias("found"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            bodies = batch.column("body").cast(pa.binary()).to_pylist()
            rows = [cut(b, f, length) for b, f in zip(bodies, batch.column("found").to_pylist(), strict=True)]
            kinds = (pa.binary(), pa.int64(), pa.int64())
            made = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *made], ["key", "kept", "n_removed", "n_spans"])

    return joined.select("key", "body").join(found, "key").mapInArrow(apply, "key binary, kept binary, n_removed long, n_spans long")


def text_key(body):
    return F.unhex(F.substring(F.sha2(body, 256), 1, 32))


def suffix_dedup_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = 200, gram: int = 64) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    lost = repeated_strings(docs, text, length, gram).select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    lost = written(lost, "suffix-lost")
    body = text_or_empty(text)
    rows = docs.select(
        F.col(id_col).alias("id"), F.octet_length(body).cast("long").alias("n_bytes"), text_key(body).alias("key"), F.sha2(body, 256).alias("whole")
    )
    return rows.join(lost, "key", "left").select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )
