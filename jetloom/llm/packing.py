"""Best-fit packing by hierarchical residuals.

Each partition encodes its texts, cuts them into pieces and packs the pieces
best-fit decreasing. Nearly full bins are finished; underfull bins go up a tree as
items: neighbouring nodes are merged, best-fit is repeated on whole bins, and so on
to the root. Every round is written to the shared folder, so a lost executor costs a
task and numbers do not change between attempts.

After best-fit at most one bin of a node is half full or less, and two bins can only
be joined if one of them is. A node of ``fan_in`` children thus joins ``fan_in`` pairs at most, and
a child's other bins can be needed only there and once for each level above: it hands up its
emptiest ``fan_in`` bins for each level that a tree of 2**28 leaves has, and finishes the
rest, which could not all be joined to anything. Any half-empty bin still finds its room, so what is
gathered in a task is bounded and the number of sequences does not suffer.

Defined results: a null text is empty and has the end token alone; null ids are carried
through; repeated rows are packed each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_path, text_or_empty
from .token_counts import tokenizer_bytes
from .tokenized import encoder

#: Pieces that one best-fit run holds; larger partitions are packed in several runs.
RUN_PIECES = 200_000
#: Numbers of nodes, and of bins of a node, have so many bits.
NODE_BITS = 28


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: indices of ``sizes`` by bin. Bins wait by free space; one integer marks the spaces in use."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, bins = 0, []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = used >> sizes[i]
        if fits:
            space = sizes[i] + (fits & -fits).bit_length() - 1
            n = free[space].pop()
            if not free[space]:
                used &= ~(1 << space)
        else:
            space, n = capacity, len(bins)
            bins.append([])
        bins[n].append(i)
        left = space - sizes[i]
        if left:
            free[left].append(n)
            used |= 1 << left
    return bins


def _schema(id_type: T.DataType) -> T.StructType:
    item = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("crc", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    return T.StructType(
        [
            T.StructField("node", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("fill", T.LongType()),
            T.StructField("closed", T.BooleanType()),
            T.StructField("items", T.ArrayType(item)),
        ]
    )


def handed_up(fan_in: int) -> int:
    """Bins that a node hands up at most: ``fan_in`` for each level of the largest tree, and the one that is half full or less."""
    return fan_in * math.ceil(NODE_BITS / math.log2(fan_in)) + 1


def _packed(bins: list[list[dict]], node: int, first: int, level: int, capacity: int, slack: int, most: int, last: bool) -> list[dict]:
    """``bins`` (lists of pieces) packed as items of their own; rows of the bins that come out."""
    fills = [sum(p["length"] for p in b) for b in bins]
    out = []
    for k, members in enumerate(best_fit(fills, capacity)):
        fill, pieces = 0, [p for i in members for p in bins[i]]
        for p in pieces:
            p["offset"] = fill
            fill += p["length"]
        out.append(
            {
                "node": node,
                "sequence_id": (level << 56) | (node << NODE_BITS) | (first + k),
                "fill": fill,
                "closed": last or fill + slack >= capacity,
                "items": pieces,
            }
        )
    for row in sorted((r for r in out if not r["closed"]), key=lambda r: (r["fill"], r["sequence_id"]))[most:]:
        row["closed"] = True
    return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text: str = "text",
    slack: int = 16,
    fan_in: int = 8,
    run_pieces: int = RUN_PIECES,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    if fan_in < 2:
        raise ValueError("fan_in must be 2 or more")
    most = handed_up(fan_in)
    spark, id_type = docs.sparkSession, docs.schema[id_col].dataType
    model = tokenizer_bytes(tokenizer_path)
    version = hashlib.sha256(model).hexdigest()
    shipped, schema = spark.sparkContext.broadcast(model), _schema(id_type)
    end = end_id.to_bytes(4, "little")

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, node, made = encoder(version, shipped.value), TaskContext.get().partitionId(), 0
        kinds, pieces, waiting = None, [], []

        def run() -> pa.RecordBatch:
            """Packs what is held; bins that stay open wait for the next run, so that a leaf hands up no more than one run does."""
            nonlocal made
            rows = _packed([[p] for p in pieces] + waiting, node, made, 0, capacity, slack, most, False)
            made += len(rows)
            pieces.clear()
            waiting[:] = [r["items"] for r in rows if not r["closed"]]
            return pa.RecordBatch.from_pylist([r for r in rows if r["closed"]], kinds)

        for batch in batches:
            if kinds is None:
                item = pa.struct([("id", batch.schema.field("id").type), ("piece", pa.int32()), *[(c, pa.int64()) for c in ("start", "length", "crc", "offset")]])
                kinds = pa.schema([("node", pa.int64()), ("sequence_id", pa.int64()), ("fill", pa.int64()), ("closed", pa.bool_()), ("items", pa.list_(item))])
            for doc, ids in zip(batch.column("id").to_pylist(), encode(batch.column("body")), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    pieces.append({"id": doc, "piece": k, "start": at // 4, "length": len(part) // 4, "crc": zlib.crc32(part), "offset": 0})
                if len(pieces) >= run_pieces:
                    yield run()
        if pieces:
            yield run()
        if waiting:
            yield pa.RecordBatch.from_pylist(_packed(waiting, node, made, 0, capacity, slack, most, False), kinds)

    def merge(level: int, last: bool):
        def run(key: tuple, table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda r: r["sequence_id"])
            bins = [r["items"] for r in rows]
            packed = _packed(bins, int(key[0].as_py()), 0, level, capacity, slack, most, last)
            return pa.Table.from_pylist(packed, table.schema)

        return run

    where = fresh_path(spark, "packing")
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("body"))
    rows.mapInArrow(leaves, schema).write.parquet(f"{where}/0")
    level, tables = 0, [spark.read.schema(schema).parquet(f"{where}/0")]
    nodes = (tables[0].agg(F.max("node")).first()[0] or 0) + 1
    while True:
        level, nodes = level + 1, -(-nodes // fan_in)
        waiting = tables[-1].where(~F.col("closed")).withColumn("node", F.floor(F.col("node") / fan_in))
        merged = waiting.groupBy("node").applyInArrow(merge(level, nodes == 1), schema)
        merged.write.parquet(f"{where}/{level}")
        tables.append(spark.read.schema(schema).parquet(f"{where}/{level}"))
        if nodes == 1:
            break
    closed = tables[0].where("closed")
    for table in tables[1:]:
        closed = closed.unionAll(table.where("closed"))
    item = F.explode("items")
    return closed.select("sequence_id", item.alias("x")).select(
        F.col("x.id").alias(id_col),
        "x.piece",
        "x.start",
        "x.length",
        F.col("x.crc").alias("ids_crc32"),
        "sequence_id",
        "x.offset",
    )
