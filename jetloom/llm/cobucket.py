"""A pair of tables rewritten into one sorted Parquet file for each table and bucket, by a tagged-union reduce-side join.

Both tables are one stream of tagged rows. One shuffle deals them out by ranges of (candidate bucket,
key, tag, columns), so that the left table's rows of a key come just before the right one's; a hot key
is simply cut by several ranges. A streaming scan of each range then sees every key once: right rows
whose key had no left row are orphans, the counts of both sides are multiplied, and the rows go to a
run file for each table and bucket. Only a range's first and last key can continue in another range: their
counts are handed on as "edges" (two rows a range), and right rows at a range's
start whose left rows may lie in an earlier one go to a run of their own until the edges are added up.
Runs of a file follow each other in the order of the ranges, so one task appends them, batch
by batch; a file with one run is moved into place. Orphans are sorted by another range shuffle.

Nothing that grows with the input is sorted or held by one task; the driver sees file names and counts, of
which there are at most two tables x buckets x ranges. Task attempts write under names of their own in a staging folder, only
names of attempts that Spark has committed are used, and the staging folder is deleted at the end.

Defined results: a null key takes ``buckets`` + 1 in both tables, a right row without a left one ``buckets``;
repeated rows stay, next to each other, and count as often as they are there; empty tables give no files.
Columns may have any names; a column of maps cannot be sorted and is refused by Spark. The folder's
file system must be one that pyarrow opens (local or mounted, HDFS, S3, GCS).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jetloom.sources.shared import remove

from .common import fresh_path, written

BUCKETS = 600
#: Rows that a writer holds before they become a row group.
GROUP_ROWS = 131_072
#: Names of the two sides in the tagged rows.
SIDES = ("left", "right")

STARTS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("n", T.LongType())]))


@dataclass(frozen=True)
class Pair:
    """Two tables, their names in the folder, the key that both have, and the number of buckets."""

    left: DataFrame
    right: DataFrame
    names: tuple[str, str] = ("left", "right")
    key: str = "key"
    buckets: int = BUCKETS


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    """Unsigned CRC-32 of "s" and the decimal key, modulo ``buckets``; null takes ``buckets`` + 1."""
    return F.coalesce((F.crc32(F.concat(F.lit("s"), key.cast("string"))) % buckets).cast("int"), F.lit(buckets + 1))


def _tagged(pair: Pair, starts: tuple[Column, Column]) -> DataFrame:
    """bucket, key, tag (0 left, 1 right), start, left, right (structs of the tables' columns, one of them null)."""
    kinds = [df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).schema["row"].dataType for df in (pair.left, pair.right)]
    sides = []
    for tag, df in enumerate((pair.left, pair.right)):
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        whole = [row.alias(name) if t == tag else F.lit(None).cast(kinds[t]).alias(name) for t, name in enumerate(SIDES)]
        key = F.col(f"`{pair.key}`")
        sides.append(df.select(bucket_of(key, pair.buckets).alias("bucket"), key.alias("key"), F.lit(tag).alias("tag"), starts[tag].cast("int").alias("start"), *whole))
    return sides[0].unionByName(sides[1])


def _ordered(rows: DataFrame, *lead: str) -> DataFrame:
    """Ranges of the order by ``lead`` and then all columns of the rows; a last number cuts even equal rows."""
    columns = [F.col(side).getField(f.name) for side in SIDES for f in rows.schema[side].dataType.fields]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*lead, *columns]
    dealt = rows.withColumn("number", F.monotonically_increasing_id()).repartitionByRange(n, *order, "number")
    return dealt.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).drop("number")


# --- files, inside tasks


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:") or "://" not in uri:
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of its file system, which tasks need."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _moved(source: str, target: str) -> None:
    """Moves a file, or finds that an earlier attempt of the task has."""
    fs, at = _opened(source)
    to = _opened(target)[1]
    fs.create_dir(to.rsplit("/", 1)[0])
    if fs.get_file_info(to).type == pafs.FileType.NotFound:
        fs.move(at, to)


class Ids:
    """SHA-256 of decimal keys joined by commas (null: empty), fed in pieces."""

    def __init__(self) -> None:
        self.hash, self.any = hashlib.sha256(), False

    def add(self, keys: pa.Array) -> None:
        if len(keys):
            text = ",".join("" if k is None else str(k) for k in keys.to_pylist())
            self.hash.update(("," * self.any + text).encode())
            self.any = True


class Run:
    """One Parquet file of sorted rows, written in row groups."""

    def __init__(self, folder: str, key: str, starts: int) -> None:
        self.uri = f"{folder}/{uuid.uuid4().hex}.parquet"
        self.key, self.ids, self.n = key, Ids(), 0
        self.starts = np.zeros(starts, np.int64)
        self.held: list[pa.Table] = []
        self.writer: pq.ParquetWriter | None = None

    def add(self, rows: pa.Table, starts: np.ndarray | None = None) -> None:
        self.held.append(rows)
        self.n += rows.num_rows
        self.ids.add(rows.column(self.key).combine_chunks())
        if starts is not None:
            self.starts += np.bincount(starts, minlength=len(self.starts))
        if sum(t.num_rows for t in self.held) >= GROUP_ROWS:
            self.flush()

    def flush(self) -> None:
        if self.held:
            table = pa.concat_tables(self.held)
            if self.writer is None:
                fs, path = _opened(self.uri)
                fs.create_dir(path.rsplit("/", 1)[0])
                self.writer = pq.ParquetWriter(path, table.schema, filesystem=fs)
            self.writer.write_table(table, GROUP_ROWS)
            self.held = []

    def close(self) -> Run:
        self.flush()
        if self.writer is not None:
            self.writer.close()
        return self

    def counts(self) -> list[dict]:
        return [{"start": int(s), "n": int(self.starts[s])} for s in np.flatnonzero(self.starts)]


def _rows_of(batch: pa.RecordBatch, tag: int) -> pa.Table:
    rows = batch.column(SIDES[tag])
    return pa.Table.from_arrays(rows.flatten(), names=[f.name for f in rows.type])


def _new_key(batch: pa.RecordBatch, *columns: str) -> np.ndarray:
    """Places where one of the columns differs from the row before; place 0 is not looked at."""
    new = np.zeros(batch.num_rows, bool)
    for name in columns:
        column = batch.column(name)
        differs = pc.not_equal(column[1:], column[:-1]).fill_null(False).to_numpy(zero_copy_only=False)
        nulls = column.is_null().to_numpy(zero_copy_only=False)
        new[1:] |= differs | (nulls[1:] != nulls[:-1])
    return new


RUNS = "part int, tag int, file int, kind string, uri string, n_rows long, ids_sha256 string"


def _manifest_schema(key: T.DataType) -> T.StructType:
    schema = T._parse_datatype_string(RUNS)
    for name, kind in (("starts", STARTS), ("key", key), ("n_left", T.LongType()), ("n_right", T.LongType()), ("joined", T.LongType())):
        schema = schema.add(name, kind)
    return schema


def _as_batch(rows: list[dict], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{f.name: r.get(f.name) for f in kind} for r in rows], kind)


def _line(part: int, tag: int, file: int, kind: str, run: Run) -> dict:
    return {"part": part, "tag": tag, "file": file, "kind": kind, "uri": run.uri, "n_rows": run.n, "ids_sha256": run.ids.hash.hexdigest(), "starts": run.counts()}


class Scan:
    """The streaming scan of one range: runs by table and bucket, orphans, and the counts of keys."""

    def __init__(self, folder: str, key: str, buckets: int, out: pa.Schema) -> None:
        self.folder, self.key, self.buckets, self.out = folder, key, buckets, out
        self.runs: dict[tuple[int, int, str], Run] = {}
        self.lines: list[dict] = []
        self.joined: dict[int, int] = {}
        self.first = True  # the key at hand is the range's first one
        self.at: tuple | None = None  # (bucket, key) at hand, with its counts so far
        self.n = [0, 0]
        self.part = 0

    def _edge(self) -> None:
        bucket, key = self.at
        self.lines.append({"part": self.part, "file": bucket, "kind": "edge", "key": key, "n_left": self.n[0], "n_right": self.n[1]})

    def _done_with_key(self) -> None:
        bucket, key = self.at
        if key is None:
            pass
        elif self.first:
            self._edge()
        else:
            self.joined[bucket] = self.joined.get(bucket, 0) + self.n[0] * self.n[1]
        self.first = False
        self.n = [0, 0]

    def _write(self, batch: pa.RecordBatch, which: np.ndarray, tag: int, bucket: int, kind: str) -> None:
        if which.any():
            part = batch.filter(pa.array(which))
            place = (tag, bucket, kind)
            if place not in self.runs:
                self.runs[place] = Run(self.folder, self.key, self.buckets + 2)
            self.runs[place].add(_rows_of(part, tag), part.column("start").to_numpy())

    def _close(self, before: int) -> None:
        """Ends the runs of buckets before this one; orphans of all buckets share a run."""
        for place in [p for p in self.runs if p[1] < before and p[2] != "orphan"]:
            self.lines.append(_line(self.part, *place, self.runs.pop(place).close()))

    def take(self, batch: pa.RecordBatch) -> None:
        self.part = batch.column("part")[0].as_py()
        buckets, tags = batch.column("bucket").to_numpy(), batch.column("tag").to_numpy()
        keys = batch.column("key")
        new = _new_key(batch, "bucket", "key")
        here = (int(buckets[0]), keys[0].as_py())
        if self.at is not None and self.at != here:
            self._done_with_key()
        begins = np.concatenate([[0], np.flatnonzero(new)])
        n_left = np.add.reduceat(tags == 0, begins, dtype=np.int64)
        n_right = np.add.reduceat(tags == 1, begins, dtype=np.int64)
        n_left[0] += self.n[0]
        n_right[0] += self.n[1]
        sizes = np.diff(np.append(begins, len(tags)))
        alone = np.repeat(n_left == 0, sizes) & (tags == 1) & (buckets < self.buckets)
        waits = np.zeros(len(tags), bool)
        waits[: sizes[0]] = self.first  # its left rows may be in an earlier range
        for bucket in dict.fromkeys(buckets.tolist()):
            self._close(bucket)
            inside = buckets == bucket
            self._write(batch, inside & (tags == 0), 0, bucket, "run")
            self._write(batch, inside & alone & waits, 1, bucket, "waits")
            self._write(batch, inside & alone & ~waits, 1, self.buckets, "orphan")
            self._write(batch, inside & (tags == 1) & ~alone, 1, bucket, "run")
        # keys that begin and end inside the batch are complete, unless they are the range's first
        self.at, self.n = here, [int(n_left[0]), int(n_right[0])]
        if len(begins) > 1:
            self._done_with_key()
            inner = slice(1, len(begins) - 1)
            products = n_left[inner] * n_right[inner] * (buckets[begins[inner]] < self.buckets)
            of, place = np.unique(buckets[begins[inner]], return_inverse=True)
            for bucket, total in zip(of.tolist(), np.bincount(place, products, len(of)).astype(np.int64).tolist() if len(of) else [], strict=True):
                self.joined[bucket] = self.joined.get(bucket, 0) + total
            last = begins[-1]
            self.at, self.n = (int(buckets[last]), keys[int(last)].as_py()), [int(n_left[-1]), int(n_right[-1])]

    def end(self) -> list[dict]:
        if self.at is not None and self.at[1] is not None:
            self._edge()
        for place, run in self.runs.items():
            self.lines.append(_line(self.part, *place, run.close()))
        self.lines += [{"part": self.part, "file": b, "kind": "count", "joined": n} for b, n in self.joined.items() if n]
        return self.lines


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _scanned(rows: DataFrame, pair: Pair, folder: str) -> DataFrame:
    """The manifest of the scan: runs, waiting runs, orphan runs, edges and counts."""
    schema = _manifest_schema(rows.schema["key"].dataType)
    out, key, buckets = _arrow(schema), pair.key, pair.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan(folder, key, buckets, out)
        for batch in batches:
            if batch.num_rows:
                scan.take(batch)
        yield _as_batch(scan.end(), out)

    return written(_ordered(rows, "bucket", "key", "tag").mapInArrow(run, schema), "cobucket-scan")


def _in_runs(rows: DataFrame, pair: Pair, folder: str) -> DataFrame:
    """Runs of (tag, file) of rows that have a ``file``, without a join."""
    schema = _manifest_schema(rows.schema["key"].dataType)
    out, key, starts = _arrow(schema), pair.key, pair.buckets + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, open_run, lines, part = None, None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            tags, files = batch.column("tag").to_numpy(), batch.column("file").to_numpy()
            begins = [0, *np.flatnonzero(_new_key(batch, "tag", "file")).tolist(), batch.num_rows]
            for lo, hi in zip(begins, begins[1:], strict=False):
                if (here := (int(tags[lo]), int(files[lo]))) != at:
                    if open_run:
                        lines.append(_line(part, *at, "run", open_run.close()))
                    at, open_run = here, Run(folder, key, starts)
                piece = batch.slice(lo, hi - lo)
                open_run.add(_rows_of(piece, here[0]), piece.column("start").to_numpy())
        if open_run:
            lines.append(_line(part, *at, "run", open_run.close()))
        yield _as_batch(lines, out)

    return written(_ordered(rows, "tag", "file", "key").mapInArrow(run, schema), "cobucket-runs")


def _whole(files: DataFrame, pair: Pair, folder: str, prefix: str, staging: str) -> DataFrame:
    """tag, file, path, n_rows, ids_sha256: each file (``runs``: array of part, later, uri, n_rows, ids_sha256, in order) put in its place by one task.

    One run is moved; several are appended batch by batch under a name of the attempt's own, which is then moved.
    """
    spark = files.sparkSession
    schema = T._parse_datatype_string("tag int, file int, path string, n_rows long, ids_sha256 string")
    out, root, key, names = _arrow(schema), _qualified(spark, folder), pair.key, pair.names

    def place(tag: int, file: int, runs: list[dict]) -> dict:
        name = f"{names[tag]}/{prefix}-{file:05d}.parquet"
        target = f"{root}/{name}"
        n, digest, source = runs[0]["n_rows"], runs[0]["ids_sha256"], runs[0]["uri"]
        if len(runs) > 1:
            made = Run(staging, key, 1)
            for r in runs:
                fs, path = _opened(r["uri"])
                with fs.open_input_file(path) as f:
                    for batch in pq.ParquetFile(f).iter_batches(65_536):
                        made.add(pa.Table.from_batches([batch]))
            made.close()
            n, digest, source = made.n, made.ids.hash.hexdigest(), made.uri
        _moved(source, target)
        return {"tag": tag, "file": file, "path": f"{folder}/{name}", "n_rows": n, "ids_sha256": digest}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _as_batch([place(r["tag"], r["file"], r["runs"]) for r in batch.to_pylist()], out)

    n = 4 * spark.sparkContext.defaultParallelism
    return written(files.repartition(n, "tag", "file").mapInArrow(run, schema), "cobucket-files", few_files=True)


def _by_file(runs: DataFrame) -> DataFrame:
    """tag, file and its runs in order; a file has at most two runs a range."""
    later = (F.col("kind") == "run").cast("int").alias("later")  # a range's waiting rows come before its others
    ordered = F.array_sort(F.collect_list(F.struct("part", later, "uri", "n_rows", "ids_sha256")))
    return runs.groupBy("tag", "file").agg(ordered.alias("runs"))


def _deleted(spark: SparkSession, paths: Iterable[str]) -> None:
    remove(spark, list(paths))


def start_files(pair: Pair, starts: tuple[Column, Column], folder: str) -> DataFrame:
    """Writes both tables in numbered sorted files, ``starts`` giving each row's number; tag, file, path, n_rows, ids_sha256."""
    spark = pair.left.sparkSession
    staging = _qualified(spark, f"{folder}/staging-{uuid.uuid4().hex}")
    rows = _tagged(pair, starts).withColumn("file", F.col("start"))
    made = _whole(_by_file(_in_runs(rows, pair, staging)), pair, folder, "start", staging)
    _deleted(spark, [staging])
    return made


def _started(spark: SparkSession, table: DataFrame, folder: str) -> tuple[DataFrame, Column]:
    """The table read from its folder of start files, and each row's start number."""
    number = F.regexp_extract(F.input_file_name(), r"start-(\d+)", 1).cast("int")
    return spark.read.schema(table.schema).parquet(folder), number


def rewrite(pair: Pair, made: DataFrame, folder: str) -> DataFrame:
    """Rewrites start files (``start_files``) into one file for each table and bucket; returns a row a file.

    tag, bucket, path, n_rows, ids_sha256, starts (start, n in order), n_joined, rewritten. A start file with
    exactly a bucket's rows stays; all other start files are deleted.
    """
    spark = pair.left.sparkSession
    staging = _qualified(spark, f"{folder}/staging-{uuid.uuid4().hex}")
    listed = made.select("tag", "file", "path", "n_rows", "ids_sha256").collect()  # names of at most 2 x (buckets + 2) files
    stored, starts = zip(
        *(
            _started(spark, table, f"{folder}/{name}") if any(r.tag == tag for r in listed) else (table.limit(0), F.lit(0))
            for tag, (table, name) in enumerate(zip((pair.left, pair.right), pair.names, strict=True))
        ),
        strict=True,
    )
    stored = Pair(*stored, pair.names, pair.key, pair.buckets)
    scan = _scanned(_tagged(stored, starts), stored, staging)

    edges = scan.where("kind = 'edge'").groupBy("file", "key").agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
    waiting = scan.where("kind = 'waits'")
    # a waiting run's key is the first edge of its range
    first = scan.where("kind = 'edge'").join(waiting.select("part", "file"), ["part", "file"], "left_semi")
    first = first.groupBy("part", "file").agg(F.min("key").alias("key"))
    matched = first.join(edges, ["file", "key"]).select("part", "file", (F.col("n_left") > 0).alias("found"))
    waiting = waiting.join(matched, ["part", "file"])
    runs = scan.where("kind = 'run'").unionByName(waiting.where("found").drop("found"))
    orphans = scan.where("kind = 'orphan'").drop("found").unionByName(waiting.where("not found").drop("found"))
    lost = [r.uri for r in orphans.select("uri").collect()]  # a name or two a range
    if lost:
        back = spark.read.schema(pair.right.schema).parquet(*lost)
        again = _tagged(Pair(stored.left.limit(0), back, pair.names, pair.key, pair.buckets), (F.lit(0), F.lit(0)))
        sorted_orphans = _in_runs(again.withColumn("file", F.lit(pair.buckets)), pair, staging)
        runs = runs.unionByName(sorted_orphans)

    of_starts = scan.where("kind = 'run'").unionByName(waiting.where("found").drop("found"))
    of_starts = of_starts.select("tag", "file", "starts").unionByName(orphans.select("tag", F.lit(pair.buckets).alias("file"), "starts"))
    lineage = of_starts.select("tag", "file", F.explode("starts").alias("s")).groupBy("tag", "file", F.col("s.start").alias("start")).agg(F.sum("s.n").alias("n"))
    lineage = written(lineage, "cobucket-lineage", few_files=True)
    sole_bucket = lineage.groupBy("tag", "start").agg(F.count("*").alias("n_files"))
    sole_start = lineage.groupBy("tag", "file").agg(F.count("*").alias("n_starts"), F.min("start").alias("start"))
    stays = sole_start.where("n_starts = 1").join(sole_bucket.where("n_files = 1"), ["tag", "start"]).select("tag", "file", "start")
    kept = stays.join(made.withColumnRenamed("file", "start"), ["tag", "start"]).select("tag", "file", "path", "n_rows", "ids_sha256")
    kept = written(kept, "cobucket-kept", few_files=True)

    moved = _by_file(runs).join(kept.select("tag", "file"), ["tag", "file"], "left_anti")
    placed = _whole(moved, pair, folder, "bucket", staging)
    staying = {r.path for r in kept.select("path").collect()}
    _deleted(spark, [staging, *(r.path for r in listed if r.path not in staying)])

    counts = edges.select("file", (F.col("n_left") * F.col("n_right")).alias("joined")).unionByName(scan.where("kind = 'count'").select("file", "joined"))
    counts = counts.groupBy("file").agg(F.sum("joined").alias("n_joined"))
    files = placed.withColumn("rewritten", F.lit(True)).unionByName(kept.withColumn("rewritten", F.lit(False)))
    ordered = lineage.groupBy("tag", "file").agg(F.array_sort(F.collect_list(F.struct("start", "n"))).alias("starts"))
    out = files.join(ordered, ["tag", "file"]).join(counts, "file", "left")
    return written(
        out.select("tag", F.col("file").alias("bucket"), "path", "n_rows", "ids_sha256", "starts", F.coalesce("n_joined", F.lit(0)).alias("n_joined"), "rewritten"),
        "cobucket-report",
        few_files=True,
    )


def cobucket(pair: Pair, starts: tuple[Column, Column], folder: str) -> DataFrame:
    """Writes the pair in start files, rewrites it by buckets, and reports the final files as the contract names them."""
    report = rewrite(pair, start_files(pair, starts, folder), folder)
    names = F.create_map(*[F.lit(x) for x in (0, pair.names[0], 1, pair.names[1])])
    columns = F.create_map(*[F.lit(x) for x in (0, ",".join(pair.left.columns), 1, ",".join(pair.right.columns))])
    line = F.array_join(F.transform("starts", lambda s: F.concat(s["start"].cast("string"), F.lit(":"), s["n"].cast("string"))), ",")
    return report.select(
        names[F.col("tag")].alias("table_name"), F.col("bucket").cast("long").alias("bucket"), "path", columns[F.col("tag")].alias("columns"),
        "n_rows", "n_joined", "ids_sha256", F.sha2(line, 256).alias("lineage_sha256"), "rewritten",
    )


def sales_pair(sales: DataFrame, lines: DataFrame, folder: str | None = None) -> DataFrame:
    """The shop's two tables: start files of sales follow the buckets two by two, those of lines the item."""
    b = bucket_of(F.col("sale_id"))
    of_sale = F.when(b % 4 == 1, b - 1).otherwise(b)
    of_item = F.coalesce(F.crc32(F.col("item_id").cast("string")) % BUCKETS, F.lit(0))
    folder = folder or fresh_path(sales.sparkSession, "cobucket")
    return cobucket(Pair(sales, lines, ("sales", "sale_lines"), "sale_id"), (of_sale, of_item), folder)
