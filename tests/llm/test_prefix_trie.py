"""The prefix trie against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from jetloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def expected(rows):
    """The report's rows, from every conversation's whole list of turns."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((turn is not None, turn or 0), md5(md5(role) + md5(text)), role, text))
    for turns in convs.values():
        turns.sort()
    rebuilt = {}
    for c, turns in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 6, convs.get(c - c % 100, [])
        rebuilt[c] = [t[2:] for t in base[:h] + turns[h:]]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    inner = {k[:-1] for k in members if k}
    out = []
    for k, cs in members.items():
        below = [x for x in members if x[: len(k)] == k]
        ends = ",".join(map(str, sorted(c for c in cs if len(rebuilt[c]) == len(k))))
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        children = sum(len(x) == len(k) + 1 for x in below)
        parent = min(members[k[:-1]]) if k else None
        out.append((min(cs), len(k), parent, len(cs), children, sum(x not in inner for x in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def checked(spark, rows, parts=3):
    got = prefix_trie.report(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    got = sorted((tuple(r) for r in got), key=str)
    assert got == expected(rows)
    return got


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(260), 90):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, t, None, 2]), rng.choice(["user", "assistant", None]), rng.choice(["hi", "é日", "", None, "long text"])))
    rows += [(None, 0, "user", "nobody's"), (rows[0][0], 3, "user", "again"), (rows[0][0], 3, "user", "again")]
    return rows


@pytest.mark.parametrize("ranges", [1, 4, 30])
def test_report(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        assert len(checked(spark, conversations(ranges))) > 90
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_deep_conversation_cut_by_ranges(spark):
    rows = [(100, t, "user", f"t{t // 2}") for t in range(75)] + [(c, t, "user", f"t{t // 2}") for c in (101, 102, 103) for t in range(9)]
    assert max(r[1] for r in checked(spark, rows)) == 75


def test_equal_turns_copies_and_turnless_conversations(spark):
    copies = [(1000 + i, t, "user", "same") for i in range(40) for t in range(2)]
    one = [(c, 0, "user", "x") for c in range(301, 330)]  # no conversation 300: some lose their only turn
    same = [(500, 1, "user", "r")] * 30
    got = checked(spark, copies + one + same)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)


def test_no_conversations_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.report(empty).count() == 0
    names = ["a", "b", "pa", "place", "part", "content", "depth", "weight", "n"]
    df = spark.createDataFrame([(1, 0, "user", "x" * 300_000)], SCHEMA).withColumns({n: F.lit(1) for n in names})
    assert prefix_trie.report(df).count() == (2 if zlib.crc32(b"1") % 6 == 0 else 1)


def test_subtree_sums_of_a_chain(spark):
    n = 100
    nodes = spark.range(n).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"), (F.col("id") - 1).alias("pa"), F.lit(0).cast("long").alias("pb"), F.col("id").alias("depth"), F.lit(1).cast("long").alias("v"))
    got = {r.a: r.v for r in prefix_trie.subtree_sums(nodes, ["v"]).collect()}
    assert got == {i: n - i for i in range(n)}
