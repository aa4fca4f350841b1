"""The trie of conversation prefixes, with sums over subtrees by pointer jumping.

A node is a distinct sequence of first turns. Its digest is the exclusive or of one 128-bit hash for each turn and its
place, so the digest of a prefix is a running exclusive or and needs no walk along the conversation; the edge to
the parent leads to the digest without the last turn. Turns are ranked and their hashes are
run up inside ranges of the order (conversation, turn), and small tables with a row for each range and conversation carry
both over from range to range: a conversation that holds a large part of all turns is cut like any other rows.

Sums over subtrees take doubling rounds. After round k a node has the sums of all nodes less than 2**k below it and a pointer to
its ancestor 2**k above; it adds its sums to that ancestor's and takes the ancestor's pointer.
Nodes less than 2**k deep have nothing left to send, so a round works on the deeper ones alone and there are
log2(depth) + 1 rounds. What is sent is added up on the map side; pointers are found by an equi-join that AQE splits where a node is hot.

The digest of a node's conversations is sequential by its contract. Their ids are sorted by ranges in many tasks and joined
in chunks there; one task streams a node's chunks, not its rows, through the hash.

Defined results: null role and text are empty; a null turn is first; equal turns are ordered by the digests of role and text; repeated
rows are repeated turns; rows without a conv_id belong to no conversation and are left out; a table without
conversations has no node at all, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Ids that are joined in one chunk.
CHUNK = 4096


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _hashes(place: Column) -> tuple[Column, Column]:
    """128 bits of a turn at its place."""
    return tuple(F.xxhash64(F.lit(seed), place.cast("long"), "content") for seed in (1, 2))


def _xor(column: str, over: str = "") -> Column:
    return F.expr(f"bit_xor({column}) {over}")


def ranked_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place (from 1), content (digest of role and text), weight (code points of the text), part (range of the order)."""
    text_, role_ = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.md5(F.concat(F.md5(role_), F.md5(text_))).alias("content"),
        F.length(text_).cast("long").alias("weight"),
    )
    order = ["conv_id", "turn", "content"]
    # the number cuts a crowd of equal rows too
    dealt = rows.withColumn("number", F.monotonically_increasing_id()).repartitionByRange(_partitions(turns), *order, "number")
    dealt = dealt.sortWithinPartitions(*order).drop("number").withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    dealt = written(dealt, "trie-turns", few_files=True)
    parts = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return dealt.join(parts, ["conv_id", "part"]).select("conv_id", "part", (F.col("at") + F.col("shift")).alias("place"), "content", "weight")


def with_shared_heads(ranked: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Conversations rebuilt: c's first h turns are those of conversation c - c % group, where h is crc32(c) % heads.

    conv_id, place, content, weight, part; conversations without a turn have one row, with place 0. A head is ``heads`` - 1 turns at most.
    """
    sizes = written(ranked.groupBy("conv_id").agg(F.max("place").alias("n")), "trie-sizes", few_files=True)
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("long")
    base = F.col("conv_id") - F.col("conv_id") % group
    convs = sizes.select("conv_id", base.alias("base"), h.alias("h"))
    of_base = sizes.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    # a conversation that is its own base stays as it is: with no head taken, none of its turns are left out
    own = F.col("conv_id") == F.col("base")
    taken = F.when(own, F.col("h")).otherwise(F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = written(convs.join(of_base, "base", "left").select("conv_id", "base", "h", taken.alias("taken"), own.alias("own")), "trie-conversations", few_files=True)

    # the plan of a conversation meets its turns a range at a time, so no key is larger than a range
    parts = ranked.groupBy("conv_id", "part").agg(F.count("*").alias("rows")).join(convs, "conv_id").drop("rows", "base")
    kept = ranked.join(parts, ["conv_id", "part"]).where(F.col("own") | (F.col("place") > F.col("h")))
    mine = kept.select("conv_id", F.when(F.col("own"), F.col("place")).otherwise(F.col("place") - F.col("h") + F.col("taken")).alias("place"), "content", "weight", "part")

    head = ranked.where((F.col("conv_id") % group == 0) & (F.col("place") < heads)).select(F.col("conv_id").alias("base"), "place", "content", "weight")
    lent = head.join(convs.where(~F.col("own")), "base").where(F.col("place") <= F.col("taken"))
    lent = lent.select("conv_id", "place", "content", "weight", F.lit(-1).alias("part"))
    void = convs.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit("").alias("content"), F.lit(0).cast("long").alias("weight"), F.lit(-1).alias("part"))
    return mine.unionByName(lent).unionByName(void)


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, a, b (digest of the prefix), pa, pb (its parent's), weight (of the last turn), last (the whole conversation)."""
    x, y = _hashes(F.col("place"))
    zero = F.lit(0).cast("long")
    hashed = turns.withColumn("x", F.when(F.col("place") == 0, zero).otherwise(x)).withColumn("y", F.when(F.col("place") == 0, zero).otherwise(y))
    hashed = written(hashed.drop("content"), "trie-hashes", few_files=True)
    parts = hashed.groupBy("conv_id", "part").agg(_xor("x").alias("px"), _xor("y").alias("py"), F.max("place").alias("top"))
    earlier = "over (partition by conv_id order by part rows between unbounded preceding and 1 preceding)"
    parts = parts.select(
        "conv_id", "part", F.coalesce(_xor("px", earlier), zero).alias("cx"), F.coalesce(_xor("py", earlier), zero).alias("cy"),
        F.max("top").over(Window.partitionBy("conv_id")).alias("size"),
    )
    upto = "over (partition by conv_id, part order by place rows between unbounded preceding and current row)"
    run = hashed.join(parts, ["conv_id", "part"])
    run = run.withColumns({"a": _xor("x", upto).bitwiseXOR(F.col("cx")), "b": _xor("y", upto).bitwiseXOR(F.col("cy"))})
    return run.select(
        "conv_id", F.col("place").alias("depth"), "a", "b", F.col("a").bitwiseXOR(F.col("x")).alias("pa"), F.col("b").bitwiseXOR(F.col("y")).alias("pb"),
        "weight", (F.col("place") == F.col("size")).alias("last"),
    )


def trie(prefix_rows: DataFrame) -> DataFrame:
    """a, b, pa, pb, depth, weight, conv_id (smallest member), n_convs, n_children of every node."""
    nodes = prefix_rows.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        *[F.first(c).alias(c) for c in ("pa", "pb", "depth", "weight")],
    )
    nodes = written(nodes, "trie-nodes", few_files=True)
    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    return written(nodes.join(children, ["a", "b"], "left").fillna(0, ["n_children"]), "trie-counted", few_files=True)


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """a, b and the sums of ``values`` over each node's subtree, itself included; ``nodes`` has a, b, pa, pb and depth."""
    sums = [F.sum(v).alias(v) for v in values]
    parts = [nodes.select("a", "b", *values)]
    active = nodes.where("depth > 0").select("a", "b", "pa", "pb", "depth", *values)
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    reach = 1
    while reach <= deepest:
        sent = active.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(*sums)
        sent = written(sent, "trie-sent", few_files=True)
        parts.append(sent)
        if 2 * reach <= deepest:
            still = active.where(F.col("depth") >= 2 * reach)
            got = sent.select("a", "b", *[F.col(v).alias(f"more_{v}") for v in values])
            above = active.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("pa").alias("qa"), F.col("pb").alias("qb"))
            grown = [(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values]
            still = still.join(got, ["a", "b"], "left").join(above, ["pa", "pb"])
            active = written(still.select("a", "b", F.col("qa").alias("pa"), F.col("qb").alias("pb"), "depth", *grown), "trie-active", few_files=True)
        reach *= 2
    total = parts[0]
    for more in parts[1:]:
        total = total.unionByName(more)
    return total.groupBy("a", "b").agg(*sums)


def id_digests(members: DataFrame) -> DataFrame:
    """a, b, ends_sha256: digest of each node's ``conv_id`` values, ascending and joined by commas."""
    n = _partitions(members)
    ordered = members.select("a", "b", "conv_id").repartitionByRange(n, "a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        out: list[tuple] = []

        def cut() -> None:
            if held:
                out.append((*key, held[0], ",".join(map(str, held))))
                held.clear()

        for batch in batches:
            for a, b, c in zip(*(batch.column(x).to_pylist() for x in ("a", "b", "conv_id")), strict=True):
                if (a, b) != key or len(held) == CHUNK:
                    cut()
                    key = (a, b)
                held.append(c)
            if out:
                yield packed(out)
                out.clear()
        cut()
        if out:
            yield packed(out)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[i], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["a", "b", "first", "ids"])

    pieces = written(ordered.mapInArrow(chunks, "a long, b long, first long, ids string"), "trie-ids", few_files=True)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hashed = None, None
        out: list[tuple] = []
        for batch in batches:
            for a, b, ids in zip(*(batch.column(x).to_pylist() for x in ("a", "b", "ids")), strict=True):
                if (a, b) == key:
                    hashed.update(b"," + ids.encode())
                    continue
                if key is not None:
                    out.append((*key, hashed.hexdigest()))
                key, hashed = (a, b), hashlib.sha256(ids.encode())
            if out:
                yield made(out)
                out.clear()
        if key is not None:
            yield made([(*key, hashed.hexdigest())])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        a, b, h = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(h, pa.string())], ["a", "b", "ends_sha256"])

    dealt = pieces.repartition(n, "a", "b").sortWithinPartitions("a", "b", "first").select("a", "b", "ids")
    return dealt.mapInArrow(digests, "a long, b long, ends_sha256 string")


def report(turns: DataFrame, group: int = 100, heads: int = 6, **names: str) -> DataFrame:
    """The contract's columns of every node."""
    ranked = written(ranked_turns(turns, **names), "trie-ranked", few_files=True)
    rows = written(prefixes(with_shared_heads(ranked, group, heads)), "trie-prefixes", few_files=True)
    nodes = trie(rows)
    leaf = (F.col("n_children") == 0).cast("long")
    sums = subtree_sums(nodes.select("a", "b", "pa", "pb", "depth", leaf.alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("weight")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    ended = id_digests(rows.where("last"))
    out = nodes.join(sums, ["a", "b"]).join(ended, ["a", "b"], "left")
    below, root = out.where("depth > 0").join(parents, ["pa", "pb"]), out.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return below.unionByName(root).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
