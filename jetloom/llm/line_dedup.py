"""Line dedup: two Bloom filters pick suspects, and only suspects are counted exactly.

A first pass over the texts fills a once-seen and a twice-seen filter per task;
merged, a line whose key is not in the twice-seen filter is certainly in fewer than
two documents. A second pass shuffles only the digests of suspected keys, pre-added
per task, for exact document counts and first occurrences. A third pass drops lines.

The filters are sized from the number of lines, eight bits for each, up to ``MAX_FILTER_BITS``, so what the
driver merges and sends is bounded at any input; a filter too small for the corpus only makes
more lines suspects. A task's slices are compressed: what it sends grows with its lines and
not with the filter. Confirmed digests are sent to the tasks while they are few
(``broadcast_keys``); beyond that they are joined to the texts by content digest.

A line's key is the line with the white space ``[\\x20\\x09-\\x0D]`` cut at both ends
and A-Z lower-cased. Keys are compared by 128-bit digests.

Defined results: a null or empty text is one empty line, which is never dropped
while ``min_chars`` is 1 or more; repeated rows count as documents of their own; of
rows that share an id, ``keep_first`` keeps the line in each; null ids come last in
the order of occurrences; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sliced, text_or_empty, written

WHITE = b" \t\n\x0b\x0c\r"
#: The filters travel in slices of so many bytes.
SLICE = 1 << 16
#: Bounds of a filter's size: a worker holds two of them, and the driver sends one to each.
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 19, 1 << 28
#: A task hands on its pre-added suspects beyond so many entries.
HELD = 100_000


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()  # bytes.lower() changes A-Z alone


def keys_of(text: bytes, min_chars: int) -> dict[bytes, int]:
    """Keys of a text with the number of the first line that has each."""
    found: dict[bytes, int] = {}
    for n, line in enumerate(text.split(b"\n")):
        key = line_key(line)
        if key and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars):
            found.setdefault(key, n)
    return found


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def _slots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _both_set(packed: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    bit = lambda p: (packed[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1
    return (bit(a) & bit(b)).astype(bool)


def _hashes(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


class Filters:
    """Once-seen and twice-seen bits of one task, packed; a key has two bits in each."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once = np.zeros(bits // 8, np.uint8)
        self.twice = np.zeros(bits // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """Hashes of documents' distinct keys, one for each document that has the key."""
        unique, times = np.unique(hashes, return_counts=True)
        a, b = _slots(unique, self.bits)
        again = (times > 1) | _both_set(self.once, a, b)
        for slot in (a, b):
            byte, bit = (slot >> np.uint64(3)).astype(np.int64), np.uint8(1) << (slot & np.uint64(7)).astype(np.uint8)
            np.bitwise_or.at(self.twice, byte[again], bit[again])
            np.bitwise_or.at(self.once, byte, bit)

    def slices(self) -> Iterator[tuple[int, bytes, bytes]]:
        once, twice = self.once.reshape(-1, SLICE), self.twice.reshape(-1, SLICE)
        for n in np.flatnonzero(once.any(axis=1)):
            yield int(n), zlib.compress(once[n].tobytes(), 1), zlib.compress(twice[n].tobytes(), 1)


_SLICES = "slice int, once binary, twice binary"


def _merge_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    merged: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            once, twice = (np.frombuffer(zlib.decompress(row[c]), np.uint8) for c in ("once", "twice"))
            if row["slice"] in merged:
                o, t = merged[row["slice"]]
                merged[row["slice"]] = [o | once, t | twice | (o & once)]
            else:
                merged[row["slice"]] = [once, twice]
    for n, (o, t) in merged.items():
        yield pa.RecordBatch.from_pydict({"slice": pa.array([n], pa.int32()), "once": [zlib.compress(o.tobytes(), 1)], "twice": [zlib.compress(t.tobytes(), 1)]})


def filter_size(texts: DataFrame) -> int:
    """Bits for a filter over the lines of ``texts.body``: a power of two, eight or more for each line, within the bounds."""
    lines = texts.agg(F.sum(1 + F.octet_length("body") - F.octet_length(F.translate("body", "\n", "")))).first()[0] or 0
    return min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, 1 << math.ceil(math.log2(8 * lines + 1))))


def twice_seen(texts: DataFrame, filter_bits: int, min_chars: int) -> bytes:
    """The merged twice-seen filter, ``filter_bits / 8`` bytes at any input."""
    if filter_bits & (filter_bits - 1) or not 8 * SLICE <= filter_bits <= 1 << 32:
        raise ValueError("filter_bits must be a power of two from 2**19 to 2**32")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, pending = Filters(filter_bits), []
        for batch in sliced(batches):
            for text in texts_of(batch, "body"):
                pending.extend(keys_of(text, min_chars))
                if len(pending) >= HELD:
                    filters.add(_hashes(pending))
                    pending.clear()
        filters.add(_hashes(pending))
        for n, once, twice in filters.slices():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([n], pa.int32()), "once": [once], "twice": [twice]})

    slices = texts.mapInArrow(fill, _SLICES)
    merged = slices.repartition(max(1, min(64, filter_bits // 8 // SLICE)), "slice").mapInArrow(_merge_slices, _SLICES)
    out = np.zeros((filter_bits // 8 // SLICE, SLICE), np.uint8)
    for row in merged.select("slice", "twice").toLocalIterator():
        out[row[0]] = np.frombuffer(zlib.decompress(bytes(row[1])), np.uint8)
    return out.tobytes()


def suspected(keys: list[bytes], packed: np.ndarray, bits: int) -> list[bytes]:
    if not keys:
        return []
    a, b = _slots(_hashes(keys), bits)
    return [keys[i] for i in np.flatnonzero(_both_set(packed, a, b))]


def repeated_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    id_col: str = "doc_id",
    text: str = "text",
    filter_bits: int | None = None,
) -> DataFrame:
    """digest (128 bits of the key), n_docs, first_doc, first_line of every key in ``min_docs`` documents or more."""
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more")
    spark, id_type = docs.sparkSession, docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("body"))
    filter_bits = filter_bits or filter_size(rows)
    shipped = spark.sparkContext.broadcast(twice_seen(rows.select("body"), filter_bits, min_chars))
    schema = T.StructType(
        [
            T.StructField("digest", T.BinaryType()),
            T.StructField("n_docs", T.LongType()),
            T.StructField("first_doc", id_type),
            T.StructField("first_line", T.LongType()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.frombuffer(shipped.value, np.uint8)
        held: dict[bytes, list] = {}

        def flush() -> pa.RecordBatch:
            columns = zip(*[(k, *v) for k, v in held.items()], strict=True)
            out = [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), kind, pa.int64()), strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays(out, schema.names)

        for batch in sliced(batches):
            ids, kind = batch.column("id").to_pylist(), batch.schema.field("id").type
            for doc, body in zip(ids, texts_of(batch, "body"), strict=True):
                lines = keys_of(body, min_chars)
                for key in suspected(list(lines), packed, filter_bits):
                    digest = xxhash.xxh3_128_digest(key)
                    entry = held.setdefault(digest, [0, doc, lines[key]])
                    entry[0] += 1
                    if doc is not None and (entry[1] is None or (doc, lines[key]) < (entry[1], entry[2])):
                        entry[1:] = doc, lines[key]
            if len(held) >= HELD:
                yield flush()
        if held:
            yield flush()

    first = F.struct(F.col("first_doc").isNull(), "first_doc", "first_line")
    return (
        rows.mapInArrow(count, schema)
        .groupBy("digest")
        .agg(F.sum("n_docs").alias("n_docs"), F.min(first).alias("first"))
        .where(F.col("n_docs") >= min_docs)
        .select("digest", "n_docs", "first.first_doc", "first.first_line")
    )


def _without(body: bytes, doc, drop: dict[bytes, tuple], keep_first: bool, min_chars: int) -> tuple[list[bytes], int]:
    """Lines that stay, and the number of all lines."""
    lines, kept = body.split(b"\n"), []
    for n, line in enumerate(lines):
        key = line_key(line)
        found = None
        if key and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars):
            found = drop.get(xxhash.xxh3_128_digest(key))
        if found is None or (keep_first and found == (doc, n)):
            kept.append(line)
    return kept, len(lines)


def line_dedup(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
    id_col: str = "doc_id",
    text: str = "text",
    filter_bits: int | None = None,
    broadcast_keys: int = 1 << 18,
) -> DataFrame:
    """Columns ``row`` (a struct of the input row without its text), ``kept_text``, ``n_lines``, ``n_dropped``, ``kept_sha256``.

    Keys in ``min_docs`` documents or more lose all their lines, or all but the first
    occurrence, by (id, line), with ``keep_first``.
    """
    spark = docs.sparkSession
    repeated = written(repeated_lines(docs, min_docs, min_chars, id_col, text, filter_bits), "repeated-lines")
    few = repeated.limit(broadcast_keys + 1).count() <= broadcast_keys
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = docs.select(others.alias("row"), F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text}`").alias("body"))
    schema = T.StructType(
        [
            rows.schema["row"],
            T.StructField("kept_text", T.StringType()),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
        ]
    )

    def dropped(drops: Callable) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches):
                out: tuple[list, ...] = ([], [], [], [])
                ids = batch.column("id").to_pylist()
                for doc, body, drop in zip(ids, texts_of(batch, "body"), drops(batch), strict=True):
                    kept, n = _without(body, doc, drop, keep_first, min_chars)
                    whole = b"\n".join(kept)
                    for column, value in zip(out, (whole.decode(), n, n - len(kept), hashlib.sha256(whole).hexdigest()), strict=True):
                        column.append(value)
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                made = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("row"), *made], schema.names)

        return run

    if few:
        table = {bytes(r[0]): (r[1], r[2]) for r in repeated.select("digest", "first_doc", "first_line").toLocalIterator()}
        shipped = spark.sparkContext.broadcast(table)
        return rows.mapInArrow(dropped(lambda batch: [shipped.value] * batch.num_rows), schema)

    # too many to send: give each text, by its content, the confirmed keys among its own
    keyed = rows.withColumn("content", F.unhex(F.sha2("body", 256)))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            pairs = [
                (c, xxhash.xxh3_128_digest(k))
                for c, body in zip(batch.column("content").to_pylist(), texts_of(batch, "body"), strict=True)
                for k in keys_of(body, min_chars)
            ]
            columns = [pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["content", "digest"])

    pairs = keyed.select("content", "body").mapInArrow(own, "content binary, digest binary").distinct()
    lists = pairs.join(repeated, "digest").groupBy("content").agg(
        F.collect_list(F.struct("digest", "first_doc", "first_line")).alias("drops")
    )

    def given(batch: pa.RecordBatch) -> list[dict]:
        return [
            {x["digest"]: (x["first_doc"], x["first_line"]) for x in drops or ()} for drops in batch.column("drops").to_pylist()
        ]

    return keyed.join(lists, "content", "left").select("row", "id", "body", "drops").mapInArrow(dropped(given), schema)


def line_dedup_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """id, n_lines, n_dropped, kept_sha256 of every document."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    out = line_dedup(slim, id_col="id", text="text", **options)
    return out.select(F.col("row.id").alias(id_col), "n_lines", "n_dropped", "kept_sha256")
