"""The co-bucketed pair against plain lists."""

from __future__ import annotations

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from jetloom.llm import cobucket

LINES = "sale_id long, line_no int, item_id long, amount double, flag string, shipped_at timestamp_ntz"
SALES = "sale_id long, client_id long, status string"


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def order(row):
    """Nulls first, strings by their bytes."""
    return [(v is not None, (v.encode() if isinstance(v, str) else v) if v is not None else 0) for v in row]


def expected(sales, lines, item_at):
    """(table, bucket): its rows in order, starting files' counts, joined rows and whether it stays."""
    bucket = lambda k: 601 if k is None else zlib.crc32(f"s{k}".encode()) % 600
    known = {r[0] for r in sales if r[0] is not None}
    final, lineage, starts = defaultdict(list), defaultdict(Counter), defaultdict(list)
    for table, rows in (("sales", sales), ("sale_lines", lines)):
        for r in rows:
            b = bucket(r[0])
            if table == "sales":
                s = b - 1 if b % 4 == 1 else b
            else:
                s = 0 if r[item_at] is None else zlib.crc32(str(r[item_at]).encode()) % 600
                b = 600 if b < 600 and r[0] not in known else b
            final[table, b].append(tuple(r))
            lineage[table, b][s] += 1
            starts[table, s].append(tuple(r))
    copies = Counter(r[0] for r in sales)
    joined = Counter()
    for r in lines:
        joined[bucket(r[0])] += copies[r[0]] if r[0] is not None else 0
    out = {}
    for (table, b), rows in final.items():
        rows.sort(key=order)
        stays = any(t == table and sorted(x, key=order) == rows for (t, _), x in starts.items())
        out[table, b] = (rows, sorted(lineage[table, b].items()), joined[b] if b < 600 else 0, stays)
    return out


def checked(spark, sales, lines):
    got = {(r.table_name, r.bucket): r for r in cobucket.sales_pair(sales, lines).collect()}
    want = expected(sales.collect(), lines.collect(), lines.columns.index("item_id"))
    assert got.keys() == want.keys()
    for place, (rows, starts, joined, stays) in want.items():
        r = got[place]
        table = pq.ParquetFile(r.path).read()
        names = (sales if place[0] == "sales" else lines).columns
        assert table.column_names == names and r.columns == ",".join(names)
        assert list(zip(*[c.to_pylist() for c in table.columns], strict=True)) == rows
        assert (r.n_rows, r.n_joined, r.rewritten) == (len(rows), joined, not stays)
        assert r.ids_sha256 == sha("" if x[0] is None else str(x[0]) for x in rows)
        assert r.lineage_sha256 == sha(f"{s}:{n}" for s, n in starts)
    if got:
        root = os.path.dirname(os.path.dirname(next(iter(got.values())).path))
        assert {os.path.join(d, f) for d, _, names in os.walk(root) for f in names} == {r.path for r in got.values()}
    return got


def test_given_tables(spark, sf_dir):
    got = checked(spark, spark.read.parquet(f"{sf_dir}/sales.parquet"), spark.read.parquet(f"{sf_dir}/sale_lines.parquet"))
    assert {r.rewritten for r in got.values()} == {True, False}


def rows_of(seed):
    """A hot sale, a sale that is there several times, orphans, null keys, repeated rows and ties."""
    rng = random.Random(seed)
    sales = [(rng.choice([i, i, None, 7]), rng.choice([None, 1]), rng.choice(["é", "z", "", None])) for i in range(60)]
    lines = []
    for _ in range(400):
        sale = rng.choice([7, 7, 7, None, 10_000 + rng.randrange(3), rng.randrange(90)])
        lines.append((sale, rng.choice([1, None]), rng.choice([5, 5, None, 6]), rng.choice([None, 0.5, 2.0]), rng.choice(["a", "Z", None]), None))
    return sales, lines


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_keys_cut_by_ranges(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        sales, lines = rows_of(ranges)
        checked(spark, spark.createDataFrame(sales, SALES).repartition(3), spark.createDataFrame(lines, LINES).repartition(5))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_orphans_of_one_key_over_many_ranges(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        lines = [(99, i, 5, None, None, None) for i in range(200)] + [(3, 1, 5, None, None, None)]
        got = checked(spark, spark.createDataFrame([(3, 1, "a")], SALES), spark.createDataFrame(lines, LINES).repartition(4))
        assert got["sale_lines", 600].n_rows == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("n_sales, n_lines", [(0, 0), (0, 30), (60, 0)])
def test_empty_tables(spark, n_sales, n_lines):
    sales, lines = rows_of(1)
    checked(spark, spark.createDataFrame(sales[:n_sales], SALES), spark.createDataFrame(lines[:n_lines], LINES))


def test_extra_columns_with_clashing_names_and_long_texts(spark):
    names = ["bucket", "key", "tag", "start", "left", "right", "file", "part", "a.b"]
    sales = [(i, *[i % 2] * len(names)) for i in range(5)]
    lines = [(i % 7, 4, *["x" * (100_000 * (i % 2))] * len(names)) for i in range(12)]
    kind = lambda t: ", ".join(f"`{n}` {t}" for n in names)
    checked(spark, spark.createDataFrame(sales, "sale_id long, " + kind("int")), spark.createDataFrame(lines, "sale_id long, item_id long, " + kind("string")))
