"""SimHash near-dedup with pigeonring filtering.

Fingerprints of 64 bits come from XXH64 of word shingles. Equal fingerprints are one
node from then on. Two fingerprints that differ in ``DISTANCE`` = 2 bits at most are
linked; links are searched among distinct fingerprints only.

Pigeonring: the 64 bits are seven segments on a ring. If the whole differs by 2 bits
at most, some segment starts a chain in which every prefix of l segments differs by
l * 2 / 7 bits at most: the first three by none, the next three by one, all by two. Three
neighbouring segments (27 or 28 bits) are therefore a join key, seven for a fingerprint;
the rest of the chain is tested next, and the full distance last.

A key that more than ``block`` fingerprints share is split by further segments: five of the
seven are equal whatever two bits differ, so its members meet again under the two of the other
four segments that are equal too (45 bits or more). Only fingerprints that share five segments
in large numbers are left; they differ in the last two segments alone, and those of them within two bits meet at the
patterns of these segments one bit away (a pattern has 20 members at most). That is exact, and no key or
block is compared with itself beyond ``block`` members.

Defined results: a null text is empty; a text without words has fingerprint 0 and is
linked like any other; documents with a null id take part and never name a component
(a component of null ids alone has a null name); repeated rows share fingerprint and
component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial, reduce
from itertools import combinations
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import near_copies
from .common import sliced, text_or_empty, written
from .components import stars

#: Lowest bit and width of the segments, in order on the ring.
SEGMENTS = ((0, 10), (10, 9), (19, 9), (28, 9), (37, 9), (46, 9), (55, 9))
#: So many segments of a chain must be equal at its start.
LEAD = 3
DISTANCE = 2
BITS = 64


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> bytes:
    """8 bytes, highest bit first: a bit is 1 if it is set in more than half of the shingles' hashes."""
    w = text.lower().split()  # bytes: A-Z alone, and the six ASCII spaces
    if not w:
        return bytes(8)
    grams = map(b" ".join, zip(*[w[i:] for i in range(words)], strict=False)) if len(w) >= words else [b" ".join(w)]
    hashes = b"".join(map(partial(xxhash.xxh64_digest, seed=seed), grams))
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(bits)).tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """id, fp (the 64 bits as a signed long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column("body").cast(pa.binary()).to_pylist()
            fps = np.frombuffer(b"".join(fingerprint(t, words, seed) for t in texts), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps)], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("body"))
    return rows.mapInArrow(run, T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())]))


def _mask(segments: Iterable[int]) -> int:
    """The bits of these segments, as a signed long."""
    bits = sum(((1 << width) - 1) << low for low, width in (SEGMENTS[k % len(SEGMENTS)] for k in segments))
    return bits - (1 << 64) if bits >> 63 else bits


def _differ(x: Column, segments: Iterable[int]) -> Column:
    return F.bit_count(x.bitwiseAND(F.lit(_mask(segments)).cast("long")))


def _chain(x: Column, start: int) -> Column:
    """Every prefix of the chain from segment ``start`` is within its proportional budget."""
    prefixes = (range(start, start + n) for n in range(1, len(SEGMENTS) + 1))
    return reduce(and_, (_differ(x, p) <= len(p) * DISTANCE // len(SEGMENTS) for p in prefixes))


def _keyed(rows: DataFrame, masks: Column) -> DataFrame:
    """``rows`` once for each mask (struct k, mask), with ``key``, the fingerprint's bits under it."""
    many = rows.select("*", F.explode(masks).alias("m"))
    return many.select(*rows.columns, F.col("m.k").alias("k"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"))


def _masks(sets: Iterable[tuple[int, Iterable[int]]]) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("k"), F.lit(_mask(s)).cast("long").alias("mask")) for k, s in sets])


def _met(keyed: DataFrame, block: int, *more: str) -> tuple[DataFrame, DataFrame]:
    """Rows that share a key, of small and of large blocks."""
    keys = [*more, "k", "key"]
    sizes = keyed.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    shared = written(keyed.join(sizes, keys), "simhash-blocks", few_files=True)
    return shared.where(F.col("n") <= block), shared.where(F.col("n") > block)


def _pairs(small: DataFrame, chain: bool) -> DataFrame:
    a, b = small.select("k", "key", F.col("fp").alias("u")), small.select("k", "key", F.col("fp").alias("v"))
    x = F.col("u").bitwiseXOR(F.col("v"))
    near = (F.col("u") < F.col("v")) & (F.bit_count(x) <= DISTANCE)
    if chain:  # the key's chain; it is the same test for every k, so one of them holds for a pair within the distance
        starts = F.lit(False)
        for k in range(len(SEGMENTS)):
            starts = F.when(F.col("k") == k, _chain(x, k)).otherwise(starts)
        near = starts & near
    return a.join(b, ["k", "key"]).where(near).select("u", "v")


def links(nodes: DataFrame, block: int = 64) -> DataFrame:
    """Pairs u < v of ``nodes.fp`` (distinct) that connect all fingerprints within two bits of each other.

    Small blocks give each pair; members of the densest ones are linked through the smallest
    fingerprint at each meeting point, which joins the same components.
    """
    ring = range(len(SEGMENTS))
    small, large = _met(_keyed(nodes.select("fp"), _masks((k, range(k, k + LEAD)) for k in ring)), block)
    found = _pairs(small, chain=True)

    # five equal segments: the three of a large key and two of the others, numbered by the two that may differ
    open_pairs = list(combinations(ring, DISTANCE))
    fives = {k: [n for n, p in enumerate(open_pairs) if not {s % len(SEGMENTS) for s in range(k, k + LEAD)} & {*p}] for k in ring}
    of_key = F.lit(None)
    for k in ring:
        masks = _masks((n, (s for s in ring if s not in open_pairs[n])) for n in fives[k])
        of_key = F.when(F.col("lead") == k, masks).otherwise(of_key)
    again = _keyed(large.select("fp", F.col("k").alias("lead")), of_key).select("fp", "k", "key").distinct()
    small, dense = _met(again, block)
    found = found.unionByName(_pairs(small, chain=False))

    flips = F.lit(None)
    for n, pair in enumerate(open_pairs):
        bits = [low + i for low, width in (SEGMENTS[s] for s in pair) for i in range(width)]
        signs = [F.lit(-(1 << 63) if i == 63 else 1 << i).cast("long") for i in bits]
        flips = F.when(F.col("k") == n, F.array(F.lit(0).cast("long"), *signs)).otherwise(flips)
    points = dense.select("k", "key", "fp", F.explode(flips).alias("flip"))
    points = points.select("k", "key", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    met = points.groupBy("k", "key", "point").agg(F.array_sort(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1)
    hubs = met.select(F.get("fps", F.lit(0)).alias("u"), F.explode(F.slice("fps", 2, BITS)).alias("v"))
    return found.unionByName(hubs).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 3, seed: int = 42, block: int = 64
) -> DataFrame:
    """id, fingerprint (16 hex digits), component_id (smallest id of the component) of every document."""
    made = written(fingerprints(docs, id_col, text, words, seed), "simhash-fingerprints")
    nodes = made.groupBy("fp").agg(F.min("id").alias("first"))
    roots = stars(links(nodes.select("fp"), block))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    linked = named.join(roots.select("root").distinct(), "root", "left_semi")
    groups = linked.groupBy("root").agg(F.min("first").alias("group_first"))
    labels = named.join(groups, "root", "left").select("fp", F.coalesce("group_first", "first").alias("component_id"))
    return made.join(labels, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def fingerprint_pairs(texts: DataFrame, words: int = 3) -> DataFrame:
    """u, v: the first of each component of fingerprints with each other member, of texts (at, text)."""
    found = near_duplicates(texts, "at", words=words)
    return found.where("component_id < at").select(F.col("component_id").alias("u"), F.col("at").alias("v"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 5, similarity: float | None = 0.8, **options) -> DataFrame:
    """One document of each group, with the columns that came in.

    ``similarity`` None: of each component of fingerprints within two bits. Else of near copies by that
    Jaccard similarity of their shingles: the components of fingerprints are found first, by pigeonring, and confirmed on the exact
    sets; ``near_copies`` then finds what is left, because two fingerprints at 0.8 differ in about ten bits, and pigeonring has no
    selective segments for so many.

    It is the one with the smallest id; null ids are last, and of repeated rows one stays.
    """
    if similarity is not None:
        return near_copies.one_of_each(docs, id_col, text, words, similarity, first=partial(fingerprint_pairs, words=words), **options)
    key = F.col("row")[id_col]
    place = F.struct(key.isNull().alias("last"), key.alias("id"), F.monotonically_increasing_id().alias("at"))
    rows = written(docs.select(F.struct("*").alias("row")).withColumn("place", place), "simhash-rows")
    found = near_duplicates(rows.select("place", F.col("row")[text].alias("text")), "place", words=words, **options)
    first = found.where(F.col("component_id") == F.col("place")).select("place")
    return rows.join(first, "place", "left_semi").select("row.*")
