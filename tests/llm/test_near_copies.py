"""The pipeline's near-copy stage against all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402

from jetloom.llm import near_copies  # noqa: E402


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def stay(rows):
    """The smallest id of each component of all near pairs."""
    sets = {d: grams(t) for d, t in rows}
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and top(a) != top(b) and jaccard(sets[a], sets[b]) >= 0.8:
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {d for d in sets if top(d) == d}


def planted():
    """Five families: one clean text and copies with a few words changed."""
    rng = random.Random(3)
    rows = []
    for f in range(5):
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        rows.append((f * 100, " ".join(base)))
        for i in range(1, 30):
            copy = list(base)
            for _ in range(rng.randint(1, 3)):
                copy[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
            rows.append((f * 100 + i, " ".join(copy)))
    rows += [(900 + i, " ".join(f"v{rng.randrange(5000)}" for _ in range(100))) for i in range(20)]
    return rows


def boilerplate(pairs=300):
    """Texts of which three fifths are the same in all; every second one is a near copy of the one before it."""
    rng = random.Random(7)
    shared = [f"b{i}" for i in range(180)]
    rows = []
    for p in range(pairs):
        own = [f"p{p}w{i}" for i in range(120)]
        rows.append((2 * p, " ".join(shared + own)))
        for _ in range(2):
            own[rng.randrange(120)] = f"q{p}"
        rows.append((2 * p + 1, " ".join(shared + own)))
    return rows


def drifting(n=40):
    """A chain: each text is near the next ones only, and all share most of their shingles."""
    words = [f"c{i}" for i in range(300 + 6 * n)]
    return [(i, " ".join(words[6 * i : 6 * i + 300])) for i in range(n)]


def kept(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(r.doc_id for r in near_copies.one_of_each(df, **options).collect())


@pytest.mark.parametrize("cross", [0, 2, 10**6])
@pytest.mark.parametrize("rows", [planted, drifting])
def test_one_of_each_component_whatever_the_way(spark, rows, cross):
    assert kept(spark, rows(), cross=cross) == sorted(stay(rows()))


def test_pairs_under_boilerplate(spark):
    rows = boilerplate()
    sets = {d: grams(t) for d, t in rows}
    assert all(jaccard(sets[2 * p], sets[2 * p + 1]) >= 0.8 for p in range(300)) and jaccard(sets[0], sets[2]) < 0.8
    assert kept(spark, rows) == [2 * p for p in range(300)]


def test_chain_with_many_copies_of_its_end(spark):
    words = [f"a{i}" for i in range(300)]
    changed = lambda n: [f"z{i}" if i % 25 == 24 and i < 25 * n else w for i, w in enumerate(words)]
    a, b, c = (" ".join(changed(n)) for n in (0, 5, 11))
    assert jaccard(grams(a), grams(b)) >= 0.8 <= jaccard(grams(b), grams(c)) and jaccard(grams(a), grams(c)) < 0.8
    rows = [(1, a), (2, b), (100, c), *[(200 + i, a + f" tail{i}") for i in range(30)]]
    assert [kept(spark, rows, cross=x) for x in (0, 16, 1000)] == [[1]] * 3


def test_given_documents_lose_no_pair(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(r.doc_id for r in near_copies.one_of_each(df).collect()) == sorted(stay(rows))


def test_prefixes_of_similar_sets_meet():
    for n in range(1, 60):
        p = near_copies.prefix_length(n, 0.8)
        assert n - p + 1 >= 0.8 * n - 1e-9 and n - p < 0.8 * n  # what lies behind the prefix cannot be enough alone


def test_stage_takes_five_words_and_four_fifths(spark, sf_dir):
    df = spark.createDataFrame(planted(), "doc_id long, text string")
    out = corpus_pipeline.near_duplicates(spark, df, sf_dir)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == sorted(stay(planted()))


def test_null_ids_repeated_rows_and_no_words(spark):
    same = " ".join(f"w{i}" for i in range(50))
    rows = [(None, same), (None, same), (7, same), (7, same), (None, "other words alone"), (None, "other words alone"), (1, None), (2, ""), (3, " \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    stays = sorted(near_copies.one_of_each(df).collect(), key=str)
    assert [(r.doc_id, r.text) for r in stays] == [(1, None), (7, same), (None, "other words alone")]
    assert near_copies.one_of_each(df.limit(0)).count() == 0


def test_very_long_texts_and_clashing_columns(spark):
    long = " ".join(f"w{i % 9973}x{i % 101}" for i in range(60_000))
    names = ["row", "at", "place", "node", "token", "size", "u", "v", "group", "n"]
    df = spark.createDataFrame([(1, long), (2, long + " end"), (3, "short text")], "doc_id long, text string").withColumns({n: F.lit(1) for n in names})
    out = near_copies.one_of_each(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]
