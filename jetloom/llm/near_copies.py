"""One document of each group of near copies: five-word shingles, Jaccard similarity of 0.8 or more, by prefix filtering.

Documents with the same words are one node. Two shingle sets of similarity t share a token among the
first n - ceil(t n) + 1 of each in any order of all tokens that is the same everywhere; the order is by
rising frequency, so that what many documents share (boilerplate, licences, quoted passages) comes last and is not looked at.
Frequencies only decide the order, so they are counted by ``PLACES`` hashed places and sent to tasks as one byte
each: 2 MB whatever the input.

Nodes that share such a token are a block. Blocks with the same members are one. A group is a
connected component of the near pairs, so a block is done when all of its members are in one component, and only pairs of different components
are compared: first all members with the first one; then, while it helps and a block has more than ``CROSS`` such
pairs for each member, all members with some of them, drawn by hash; then all pairs that are left, dealt out in slices.
Pairs that cannot be near by their sizes and by how many of their first tokens others have are not formed. Every pair is confirmed on the two whole shingle sets, by 64-bit hashes. No near pair is lost, and the result
does not depend on how blocks are worked on.

Fingerprints of 64 bits alone do not serve here: at similarity 0.8 two of them differ in
about ten bits, and a search within so many bits has no selective segments. ``simhash`` proposes the pairs within two bits first.

Defined results: a null text is empty; texts without words are copies of each other; the
smallest id of a group stays, null ids are last, and of repeated rows one stays. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jetloom.sources.shared import recording, remove

from .common import sliced, written
from .components import stars

WORDS, SIMILARITY = 5, 0.8
#: Places of the frequency map, and how many of them are sent in a row.
PLACES, CHUNK = 1 << 21, 1 << 13
#: Pairs of different components are all compared if there are at most so many for each member of a block, or of all open blocks together.
CROSS = 32
#: Members drawn in a round of a larger block, and rounds; they end when one has not left a tenth less to compare.
DRAWN, ROUNDS = 8, 6
#: Members of a block in a slice.
SLICE = 256


def shingles(words: list[bytes], k: int = WORDS) -> set[bytes]:
    """All runs of ``k`` words; of a shorter text the whole, of one without words the empty string."""
    if len(words) < k:
        return {b" ".join(words)}
    return set(map(b" ".join, zip(*[words[i:] for i in range(k)], strict=False)))


def hashes(text: bytes, k: int = WORDS) -> np.ndarray:
    """The distinct shingles' hashes, in order."""
    words = text.lower().split()  # bytes: A-Z alone, and the six ASCII spaces
    return np.unique(np.frombuffer(b"".join(map(partial(xxhash.xxh64_digest, seed=42), shingles(words, k))), ">u8").astype(np.uint64))


def prefix_length(n: int, least: float) -> int:
    return n - int(np.ceil(least * n - 1e-9)) + 1


def _places(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(PLACES - 1)).astype(np.int64)


def _noded(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """row, at (unique number), place (order of the documents), node (same words, same node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column("row").field(text).cast(pa.binary()).to_pylist()
            nodes = [xxhash.xxh3_128_hexdigest(b" ".join((t or b"").lower().split())) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(nodes, pa.string())], ["row", "node"])

    rows = docs.select(F.struct("*").alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("node", T.StringType())])
    key = F.col("row")[id_col]
    made = rows.mapInArrow(run, schema).withColumn("at", F.monotonically_increasing_id())
    return written(made.withColumn("place", F.struct(key.isNull().alias("last"), key.alias("id"), "at")), "near-rows")


def _frequencies(texts: DataFrame, k: int) -> np.ndarray:
    """One byte for each place: the logarithm of the number of nodes with a shingle there."""
    spark = texts.sparkSession

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(PLACES, np.int64)
        for batch in sliced(batches):
            for t in batch.column("text").cast(pa.binary()).to_pylist():
                np.add.at(held, _places(hashes(t, k)), 1)
        if held.any():
            parts = held.reshape(-1, CHUNK)
            packed = [pa.compress(p.tobytes(), "zstd", asbytes=True) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(packed, pa.binary())], ["chunk", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                counts = np.frombuffer(pa.decompress(packed, CHUNK * 8, "zstd", asbytes=True), np.int64)
                totals[chunk] = totals.get(chunk, 0) + counts
        levels = [np.floor(4 * np.log2(1 + c)).astype(np.uint8).tobytes() for c in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(levels, pa.binary())], ["chunk", "counts"])

    few = texts.coalesce(2 * spark.sparkContext.defaultParallelism)
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), PLACES // CHUNK)
    out = np.zeros(PLACES, np.uint8).reshape(-1, CHUNK)
    kind = "chunk int, counts binary"
    for r in few.mapInArrow(counted, kind).repartition(n, "chunk").mapInArrow(added, kind).collect():  # PLACES bytes in all
        out[r.chunk] = np.frombuffer(r.counts, np.uint8)
    return out.ravel()


def _prefixes(texts: DataFrame, levels: Broadcast, k: int, least: float) -> DataFrame:
    """at, size (shingles), token: the first tokens of each node, rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in sliced(batches):
            sizes, tokens = [], []
            for t in batch.column("text").cast(pa.binary()).to_pylist():
                h = hashes(t, k)
                order = (level[_places(h)].astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))
                p = prefix_length(len(h), least)
                sizes.append(len(h))
                tokens.append(np.partition(order, p - 1)[:p].view(np.int64))
            at = np.cumsum([0, *map(len, tokens)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(tokens) if tokens else [], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.array(sizes, pa.int64()), lists], ["at", "size", "tokens"])

    made = texts.mapInArrow(run, "at long, size long, tokens array<long>")
    return made.select("at", "size", F.explode("tokens").alias("token"))


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, least: float) -> DataFrame:
    """The pairs u, v whose whole shingle sets are similar enough."""
    a, b = texts.toDF("u", "u_text"), texts.toDF("v", "v_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, None
        for batch in sliced(batches):
            keep = []
            for u, x, y in zip(batch.column("u").to_pylist(), batch.column("u_text").cast(pa.binary()), batch.column("v_text").cast(pa.binary()), strict=True):
                if u != last:
                    last, mine = u, hashes(x.as_py(), k)
                other = hashes(y.as_py(), k)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                keep.append(both >= least * (len(mine) + len(other) - both) - 1e-9)
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(kept) for c in ("u", "v")], ["u", "v"])

    return pairs.join(b, "v").join(a, "u").select("u", "v", "u_text", "v_text").mapInArrow(run, "u long, v long")


def _may(u: str, v: str, least: float, shared: Column | None = None) -> Column:
    """Two sets with ``size`` shingles, of whose first tokens ``shared`` are first tokens of others too, can be similar enough.

    Of two prefixes take the one that ends first in the order: what it has in common with the other set lies in the
    other's prefix. So both have no more in common than the first tokens that both have (``shared``; at most the smaller of the numbers)
    and what is behind that prefix.
    """
    a, b = (F.col(f"{x}.size") for x in (u, v))
    behind = lambda n: F.ceil(least * n - 1e-9) - 1
    most = (F.least(F.col(f"{u}.shared"), F.col(f"{v}.shared")) if shared is None else shared) + F.greatest(behind(a), behind(b))
    return (F.least(a, b) >= least * F.greatest(a, b) - 1e-6) & (most * (1 + least) >= least * (a + b) - 1e-6)


def _blocks(tokens: DataFrame) -> DataFrame:
    """token, at, set (size, shared: tokens that others have too), tokens of all nodes that share a token with another; of ``tokens`` with the same nodes one stays."""
    seen = tokens.groupBy("token").agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(at))").alias("x"), F.min("at").alias("first")).where("n > 1")
    seen = written(seen, "near-shared", few_files=True)
    one = seen.groupBy("n", "x", "first").agg(F.min("token").alias("token"), F.count("*").alias("tokens")).select("token", "tokens")
    met = written(tokens.join(seen.select("token"), "token", "left_semi"), "near-met", few_files=True)
    shared = met.groupBy("at").agg(F.count("*").alias("shared"))
    return met.join(one, "token").join(shared, "at").select("token", "at", F.struct("size", "shared").alias("set"), "tokens")


class _Groups:
    """Links found so far and the components that they make."""

    def __init__(self, texts: DataFrame, k: int, least: float) -> None:
        self.texts, self.k, self.least = texts, k, least
        self.roots: DataFrame | None = None

    def compare(self, pairs: DataFrame) -> None:
        """Confirms pairs (u, v) and takes the near ones as links."""
        pairs = written(pairs.select("u", "v").distinct(), "near-pairs", few_files=True)
        links = _confirmed(pairs, self.texts, self.k, self.least)
        if self.roots is not None:
            links = links.unionByName(self.roots.select(F.col("root").alias("u"), F.col("at").alias("v")))
        self.roots = written(stars(links).withColumnRenamed("node", "at"), "near-roots", few_files=True)

    def open(self, blocks: DataFrame) -> DataFrame:
        """Members of the blocks that are not all in one component yet: token, at, set, own, tokens, group, n, cross (pairs of different groups).

        What two of different groups share is in such blocks, so only their tokens count as shared from now on; ``own`` lists those of a member.
        """
        named = blocks.select("token", "at", "set", "tokens").join(self.roots, "at", "left").select("token", "at", "set", "tokens", F.coalesce("root", "at").alias("group"))
        by_group = named.groupBy("token", "group").agg(F.count("*").alias("n"))
        kept = by_group.groupBy("token").agg(F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares")).where("groups > 1")
        kept = kept.select("token", "n", ((F.col("n") * F.col("n") - F.col("squares")) / 2).alias("cross"))
        rows = written(named.join(kept, "token"), "near-open", few_files=True)
        # a block that stands for k tokens is k numbers from its own on; a node has no more of them than first tokens
        numbers = F.transform(F.sequence(F.lit(0).cast("long"), F.col("tokens") - 1), lambda i: F.col("token") + i)
        own = rows.groupBy("at").agg(F.sum("tokens").alias("shared"), F.flatten(F.collect_list(numbers)).alias("own"))
        return rows.join(own, "at").withColumn("set", F.struct("set.size", "shared")).drop("shared")


def _pairs(left: DataFrame, right: DataFrame, least: float, once: bool = False) -> DataFrame:
    """u, v: members of ``left`` with those of ``right`` in the same block and of another group, if they can be near; ``once``: the two are the same.

    A pair is formed in the first of the blocks that it shares. Large blocks are dealt out in slices.
    """
    slices = F.ceil(F.col("n") / SLICE).cast("int")
    a = left.select("token", F.pmod(F.xxhash64("at"), slices).cast("int").alias("slice"), F.struct("at", "set.*", "group", "own").alias("a"))
    b = right.select("token", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), F.struct("at", "set.*", "group", "own").alias("b"))
    both = F.array_intersect("a.own", "b.own")
    near = _may("a", "b", least) & _may("a", "b", least, F.size(both)) & (F.array_min(both) == F.col("token"))
    met = a.join(b, ["token", "slice"]).where((F.col("a.group") != F.col("b.group")) & near)
    met = met.where("a.at < b.at") if once else met
    return met.select(F.least("a.at", "b.at").alias("u"), F.greatest("a.at", "b.at").alias("v"))


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, least: float = SIMILARITY, cross: int = CROSS, first: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """One document of each group, with the columns that came in.

    ``cross`` decides how large blocks are worked on, and not the result. ``first`` gives pairs (u < v) of a table of texts (at, text) that
    another search proposes: they are confirmed like the others, before them, so that what it finds is not searched again.
    """
    spark = docs.sparkSession
    with recording() as scratch:
        with recording() as kept:
            made = _noded(docs, id_col, text)
        stays = _first_of_groups(made, text, words, least, cross, first)
        with recording() as last:
            stays = written(stays, "near-stays", few_files=True)
    remove(spark, {*scratch} - {*kept, *last})  # the result reads these two
    return made.join(stays, "place", "left_semi").select("row.*")


def _first_of_groups(made: DataFrame, text: str, words: int, least: float, cross: int, proposed: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """place of the first document of each group."""
    spark = made.sparkSession
    nodes = made.groupBy("node").agg(F.min("place").alias("place"), F.min("at").alias("at"))
    nodes = written(nodes, "near-nodes", few_files=True)
    texts = made.select("at", F.coalesce(F.col("row")[text], F.lit("")).alias("text")).join(nodes.select("at"), "at", "left_semi")
    texts = written(texts, "near-texts", few_files=True)
    levels = spark.sparkContext.broadcast(_frequencies(texts, words))
    blocks = written(_blocks(written(_prefixes(texts, levels, words, least), "near-tokens", few_files=True)), "near-blocks", few_files=True)

    groups = _Groups(texts, words, least)
    if proposed:
        groups.compare(proposed(texts))
    first = blocks.groupBy("token").agg(F.min(F.struct("at", "set")).alias("f")).select("token", F.col("f.at").alias("u"), F.col("f.set").alias("u_set"))
    groups.compare(blocks.join(first, "token").where((F.col("at") != F.col("u")) & _may("u_set", "set", least)).select("u", F.col("at").alias("v")))
    left = groups.open(blocks)
    work = lambda: left.where(F.col("cross") > cross * F.col("n")).agg(F.sum(F.col("cross") / F.col("n"))).first()[0] or 0  # noqa: E731  a block's pairs
    before = work()
    for k in range(ROUNDS if before > cross * left.count() else 0):  # a round is a pass over all open blocks
        large = left.where(F.col("cross") > cross * F.col("n"))
        groups.compare(_pairs(large, large.where(F.pmod(F.xxhash64(F.lit(k), "at"), F.col("n")) < DRAWN), least))
        left = groups.open(left)
        last, before = before, work()
        if before <= cross * left.count() or before > 0.9 * last:
            break
    groups.compare(_pairs(left, left, least, once=True))

    roots = groups.roots
    named = nodes.join(roots, "at", "left").select("place", F.coalesce("root", "at").alias("group"))
    return named.groupBy("group").agg(F.min("place").alias("place")).select("place")
