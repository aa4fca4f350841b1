"""Decontamination against plain windows."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jetloom.llm import decontaminate
from jetloom.llm.decontaminate import Automaton

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UPPER, LOWER)))


def plain(text, items, window=10):
    """n_words, n_hit, the items' ids."""
    w, hit, found = words(text), set(), set()
    for name, body in items:
        i = words(body)
        m = min(window, len(i))
        for run in {tuple(i[k : k + m]) for k in range(len(i) - m + 1)} if m else ():
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) == run:
                    hit.update(range(k, k + m))
                    found.add(name)
    return len(w), len(hit), found


def rows(seed, vocabulary=6):
    """Items with long, short, equal, null and wordless texts; texts that hold parts of them."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["Aa", "b", "é", "9", "cc", "日本"][:vocabulary])
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 9, 10, 11, 30])))) for i in range(12)]
    items += [(3, "only here"), (None, "nobody's own seven words stand here now"), (50, None), (51, " -- "), (52, items[0][1])]
    docs = [(1, None), (2, ""), (3, " .,! "), (4, items[0][1]), (4, items[0][1]), (None, "x " + items[4][1] + " y")]
    for d in range(30):
        parts = []
        for _ in range(rng.randrange(5)):
            i = words(rng.choice(items)[1])
            lo = rng.randrange(len(i) + 1)
            parts += i[lo : lo + rng.randrange(1, 20)] + [word() for _ in range(rng.randrange(12))]
        docs.append((100 + d, ", ".join(parts).upper() if d % 2 else "\n".join(parts)))
    docs.append((900, " ".join(word() for _ in range(20_000)) + " only HERE"))
    return docs, items


def checked(spark, docs, items, **options):
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in decontaminate.report(d.repartition(2), i, **options).collect()), key=str)
    want = []
    for doc, text in docs:
        n, hit, found = plain(text, items)
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        want.append((doc, n, hit, len(found), hashlib.sha256(ids.encode()).hexdigest(), hit > 0))
    assert got == sorted(want, key=str)
    return got


@pytest.mark.parametrize("shard_words", [200_000, 40])
def test_report(spark, shard_words):
    docs, items = rows(shard_words)
    assert any(r[5] for r in checked(spark, docs, items, shard_words=shard_words))


def test_no_items_and_no_documents(spark):
    docs, items = rows(1)
    checked(spark, docs[:8], [])
    checked(spark, [], items)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), max_size=5), st.lists(st.sampled_from("abcd"), max_size=40), st.integers(1, 6))
def test_automaton(items, text, window):
    named = [(k, [w.encode() for w in i]) for k, i in enumerate(items)]
    spans, found = Automaton(window).build([x for x in named if x[1]]).found([w.encode() for w in text])
    n, hit, names = plain(" ".join(text), [(k, " ".join(i)) for k, i in enumerate(items)], window)
    assert sum(b - a for a, b in spans) == hit and all(a < b for a, b in spans)
    assert len(found) == len(names)


def test_items_cut_over_shards_lose_no_window(spark):
    item = " ".join(f"w{i}" for i in range(200))
    docs = [(k, " ".join(f"w{i}" for i in range(k, k + 11))) for k in range(0, 190, 7)]
    assert all(r[2] == 11 for r in checked(spark, docs, [(1, item)], shard_words=25))


def test_removal_keeps_the_rest_and_the_columns(spark):
    item = " ".join(f"w{i}" for i in range(12))
    docs = [(1, f"Before, {item.upper()}! After.", 7), (2, item, 8), (3, "clean text", 9), (4, None, 10)]
    df = spark.createDataFrame(docs, "doc_id long, text string, spans int")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = sorted(tuple(r) for r in decontaminate.decontaminated(df, items).collect())
    assert out == [(1, "Before, ! After.", 7), (2, "", 8), (3, "clean text", 9), (4, None, 10)]
    some = decontaminate.decontaminated(df, items, max_coverage=0.9, max_words=12).orderBy("doc_id").collect()
    assert [tuple(r) for r in some] == [docs[0], docs[2], docs[3]]


def test_clashing_columns(spark):
    names = ["row", "spans", "n_words", "item_ids", "body", "name", "words"]
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string").withColumns({n: F.lit(1) for n in names})
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string").withColumns({n: F.lit(1) for n in names})
    assert [r.n_hit for r in decontaminate.report(df, items).collect()] == [2]
