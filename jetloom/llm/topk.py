"""Exact top-k inner products through a pivot-distance index.

Vectors become integers, floor(1024 * x). With one more component, the root of what
their squared norm lacks to the largest one (0 for a query), a larger inner product is
a smaller distance, so distances to pivots bound scores by the triangle inequality.

Index: each vector belongs to its nearest pivot; vectors sorted by (pivot, distance,
id) are cut into annuli of at most ``annulus`` vectors. Search: queries in blocks
start from the k-th best score in the bounded sample that gave the pivots; a query
block meets only the annuli that some query's ring reaches, nearest first, and each
annulus is computed only for the queries it can still improve. Scores found on the way shrink
the rings, and a block's scan ends at the first annulus that lies beyond all of them: the later ones are
farther still. Every row is indexed; what is not looked at holds no answer by the bound, so the result is exact.

Sorting by id too lets any number of equal vectors be dealt over many partitions.

Defined results: vectors that are null or hold null, NaN or infinite components take
no part; shorter vectors count as padded with zeros; a null id is no query and, as a
candidate, comes last among ties; rows with the query's id are its own; repeated query
ids are one query; scores beyond 64 bits are clipped to that range; fewer than k
candidates give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

_LAST = np.iinfo(np.int64).max  # stands for a null id inside the kernels


def integer_vectors(table: DataFrame, id_col: str, vector: str, scale: float = 1024.0) -> DataFrame:
    """id, v array<double> of whole numbers, of the rows that take part."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floor() gives a long; a double of 2**50 or more times the scale is whole already
    whole = F.transform(doubles, lambda x: F.when(F.abs(x) < 2.0**50, F.floor(x * scale).cast("double")).otherwise(x * scale))
    return table.where(F.col(vector).isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))


def _matrix(column, dim: int) -> np.ndarray:
    rows = [np.asarray(r, np.float64) for r in column.to_pylist()]
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _pack(m: np.ndarray) -> bytes:
    """Whole numbers as 32-bit integers where they fit, else as doubles; the first byte tells."""
    small = not m.size or np.abs(m).max() < 2**31
    return b"i" + m.astype("<i4").tobytes() if small else b"d" + m.astype("<f8").tobytes()


def _unpack(blob: bytes, dim: int) -> np.ndarray:
    flat = np.frombuffer(blob, "<i4" if blob[:1] == b"i" else "<f8", offset=1)
    return flat.astype(np.float64).reshape(-1, dim) if dim else np.zeros((0, 0))


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while every partial sum is below 2**53, else in Python's integers."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if np.abs(q).max() * np.abs(x).max() * q.shape[1] < 2.0**53:
        return (q @ x.T).astype(np.int64)
    whole = [[sum(int(a) * int(b) for a, b in zip(r, s, strict=True)) for s in x] for r in q]
    return np.array([[max(-(2**63), min(2**63 - 1, n)) for n in r] for r in whole], np.int64)


def _lifted(m: np.ndarray, top: float, query: bool = False) -> np.ndarray:
    """The extra component that turns large inner products into small distances."""
    more = np.zeros(len(m)) if query else np.sqrt(np.maximum(top - (m * m).sum(axis=1), 0))
    return np.hstack([m, more[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def pivots_of(sample: np.ndarray, n: int, rounds: int = 5) -> np.ndarray:
    """Centres of a few k-means rounds from evenly spread rows of the sample."""
    centres = sample[np.unique(np.linspace(0, len(sample) - 1, min(n, len(sample))).astype(int))].copy()
    for _ in range(rounds):
        nearest = _distances(sample, centres).argmin(axis=1)
        for k in range(len(centres)):
            if (own := nearest == k).any():
                centres[k] = sample[own].mean(axis=0)
    return centres


def _best(query: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best of each query: higher scores, then smaller ids."""
    order = np.lexsort((ident, ~score, query))  # ~ turns the order of integers without overflow
    query, score, ident = query[order], score[order], ident[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < k
    return query[keep], score[keep], ident[keep]


def top_k(
    table: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector: str = "embedding",
    every: int = 100,
    pivots: int = 32,
    sample_rows: int = 4096,
    annulus: int = 1024,
    block: int = 512,
    shards: int = 16,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each row whose id is divisible by ``every``."""
    spark = table.sparkSession
    base = written(integer_vectors(table, id_col, vector), "topk-vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    is_query = F.col("id") % every == 0
    n_queries, dim, top = base.agg(F.sum(is_query.cast("long")), F.max(F.size("v")), F.max(norm)).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n_queries:
        return empty
    dim, top = int(dim), float(top)

    # what is fitted: pivots and starting scores, on the rows with the smallest hashes
    rows = base.orderBy(F.xxhash64("id"), "id", "v").limit(sample_rows).collect()
    ids = np.array([_LAST if r[0] is None else r[0] for r in rows], np.int64)
    sample = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        sample[i, : len(r[1])] = r[1]
    shipped = spark.sparkContext.broadcast((pivots_of(_lifted(sample, top), pivots), ids, sample))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shipped.value[0]
        for batch in batches:
            m = _matrix(batch.column("v"), dim)
            d = _distances(_lifted(m, top), centres)
            near = d.argmin(axis=1) if len(d) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])], ["id", "v", "pivot", "distance"]
            )

    def rings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done() -> pa.RecordBatch:
            idents = np.array([_LAST if h[0] is None else h[0] for h in held], "<i8").tobytes()
            m = np.zeros((len(held), dim))
            for i, h in enumerate(held):
                m[i, : len(h[1])] = h[1]
            row = {"pivot": held[0][2], "lo": held[0][3], "hi": held[-1][3], "ids": idents, "vectors": _pack(m)}
            kinds = (pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds, strict=True)], list(row))

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("id", "v", "pivot", "distance")], strict=True):
                if held and (held[0][2] != row[2] or len(held) >= annulus):
                    yield done()
                    held = []
                held.append(row)
        if held:
            yield done()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = base.mapInArrow(assign, "id long, v array<double>, pivot int, distance double")
    placed = placed.repartitionByRange(parts, "pivot", "distance", "id").sortWithinPartitions("pivot", "distance", "id")
    index = placed.mapInArrow(rings, "pivot int, lo double, hi double, ids binary, vectors binary")
    index = written(index.withColumn("ring", F.monotonically_increasing_id()), "topk-index")

    # query blocks: ids, vectors, starting scores, and for each pivot how far their rings reach
    blocks = -(-int(n_queries) // block)
    asked = base.where(is_query).dropDuplicates(["id"]).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

    def gather(key: tuple, rows: pa.Table) -> pa.Table:
        centres, sample_ids, known = shipped.value
        own = np.array(rows.column("id").to_pylist(), np.int64)
        m = _matrix(rows.column("v"), dim)
        least = np.full(len(own), np.iinfo(np.int64).min)
        if len(sample_ids) > k:
            s = _scores(m, known)
            s[own[:, None] == sample_ids[None, :]] = np.iinfo(np.int64).min
            least = np.partition(s, len(sample_ids) - k, axis=1)[:, len(sample_ids) - k]
        d, reach = _distances(_lifted(m, top, True), centres), _reach(m, least, top)
        reached = ((d - reach[:, None]).min(axis=0), (d + reach[:, None]).max(axis=0), d.min(axis=0), d.max(axis=0))
        row = [key[0].as_py(), own.astype("<i8").tobytes(), _pack(m), least.astype("<i8").tobytes(), *[x.tolist() for x in reached]]
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), *[pa.list_(pa.float64())] * 4)
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], ["block", "q_ids", "q_vectors", "least", *ends])

    ends = ["from", "to", "near", "far"]  # for each pivot: where rings begin and end, and the distances of the block's nearest and farthest query
    queries = asked.groupBy("block").applyInArrow(gather, "block int, q_ids binary, q_vectors binary, least binary, from array<double>, to array<double>, near array<double>, far array<double>")
    queries = written(queries, "topk-queries")
    spans = queries.select("block", F.posexplode(F.arrays_zip(*ends)).alias("pivot", "x")).select("block", "pivot", "x.*")
    pairs = index.select("ring", "pivot", "lo", "hi").join(spans, "pivot").where("hi >= from and lo <= to")
    # how far the annulus is from any of the block's queries, at least
    pairs = pairs.select("ring", "block", F.greatest(F.col("lo") - F.col("far"), F.col("near") - F.col("hi"), F.lit(0.0)).alias("gap"))
    work = index.join(pairs, "ring").join(queries.drop(*ends), "block").withColumn("shard", F.pmod(F.xxhash64("ring"), F.lit(shards)))
    work = work.repartition(parts, "block", "shard").sortWithinPartitions("block", "shard", "gap", "ring")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, key, state = shipped.value[0], None, None
        for batch in batches:
            for row in batch.to_pylist():
                if key != (row["block"], row["shard"]):
                    if state is not None:
                        yield state.rows()
                    key, state = (row["block"], row["shard"]), _Search(row, centres, dim, top, k)
                if not state.ended(row["gap"]):
                    state.ring(row)
        if state is not None:
            yield state.rows()

    found = work.select("block", "shard", "pivot", "lo", "hi", "gap", "ids", "vectors", "q_ids", "q_vectors", "least").mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _reach(q: np.ndarray, least: np.ndarray, top: float) -> np.ndarray:
    """Largest distance at which a score of ``least`` or more is possible, rounded up."""
    squares = (q * q).sum(axis=1) + top
    radius = np.sqrt(np.maximum(squares - 2 * least.astype(np.float64), 0))
    return radius + 1e-6 * np.sqrt(squares) + 1e-6


class _Search:
    """One query block over the annuli of one shard, nearest first."""

    def __init__(self, row: dict, centres: np.ndarray, dim: int, top: float, k: int):
        self.ids = np.frombuffer(row["q_ids"], "<i8")
        self.q = _unpack(row["q_vectors"], dim)
        self.least = np.frombuffer(row["least"], "<i8").copy()
        self.dim, self.top, self.k = dim, top, k
        self.far = _distances(_lifted(self.q, top, True), centres)
        self.reach = _reach(self.q, self.least, top)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def ended(self, gap: float) -> bool:
        """Whether an annulus at this distance, and so every later one, is beyond all rings."""
        return gap > self.reach.max(initial=-1.0)

    def ring(self, row: dict) -> None:
        d = self.far[:, row["pivot"]]
        live = np.flatnonzero(np.maximum(row["lo"] - d, d - row["hi"]) <= self.reach)
        if not len(live):
            return
        ids = np.frombuffer(row["ids"], "<i8")
        s = _scores(self.q[live], _unpack(row["vectors"], self.dim))
        i, j = np.nonzero((s >= self.least[live, None]) & (self.ids[live, None] != ids[None, :]))
        self.parts.append((live[i], s[i, j], ids[j]))
        self.size += len(i)
        if self.size > 2 * self.k * len(self.ids):
            self.compact()

    def compact(self) -> None:
        query, score, ident = _best(*[np.concatenate(c) for c in zip(*self.parts, strict=True)], self.k)
        self.parts, self.size = [(query, score, ident)], len(query)
        last = np.searchsorted(query, np.arange(len(self.ids)), side="right") - 1
        full = np.bincount(query, minlength=len(self.ids)) >= self.k
        self.least[full] = np.maximum(self.least[full], score[last[full]])
        self.reach = _reach(self.q, self.least, self.top)

    def rows(self) -> pa.RecordBatch:
        if self.parts:
            self.compact()
        query, score, ident = self.parts[0] if self.parts else (np.zeros(0, np.int64),) * 3
        null = ident == _LAST
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[query]), pa.array(ident, mask=null), pa.array(score)], ["query_id", "vec_id", "score"]
        )
