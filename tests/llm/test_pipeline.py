"""The pipeline's stages against plain versions of what each decides, on the smallest tables."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

P = pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402

from jetloom.llm.common import written  # noqa: E402


def test_stages(spark, sf_dir):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    outs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        outs.append(written(stage(spark, outs[-1], sf_dir), "test-" + name.split()[0]))
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert outs[-1].dtypes == docs.dtypes
    rows = [[(r.doc_id, r.source, r.text) for r in o.collect()] for o in outs[:-1]]
    base, kept, cut, single, mixed = rows

    passed = {d for d, _, t in base if not brute.quality(t)[5]}
    assert {d for d, _, _ in kept} <= passed and len(kept) > 0.7 * len(passed)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    lost = [d for d in passed - {d for d, _, _ in kept} if labels.get(d) == 1]
    assert not lost  # clean documents stay

    import hashlib

    want = {d: s for d, _, _, s in brute.line_dedup([(d, t) for d, _, t in kept])}
    assert {d: hashlib.sha256(t.encode()).hexdigest() for d, _, t in cut} == want
    sets = {d: brute.shingles(t) for d, _, t in cut}
    stay = {d for d, _, _ in single}
    assert all(brute.jaccard(sets[a], sets[b]) < 0.8 for a in stay for b in stay if a < b)
    assert all(any(brute.jaccard(sets[d], sets[e]) >= 0.8 for e in sets if e != d) for d in set(sets) - stay)
    taken = {d: v[3] for d, v in brute.mix(single).items() if v[3]}
    words: dict = {}
    for d, _, t in mixed:
        words[d] = words.get(d, 0) + len(brute.WORDS.findall(t))
    assert words == taken

    pieces = outs[-1].collect()
    tokenizer, lengths = Tokenizer.from_file(P.path("word_bpe_49k.json")), []
    for _, _, t in mixed:
        n = len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
        lengths += [4096] * (n // 4096) + ([n % 4096] if n % 4096 else [])
    assert sorted(p.length for p in pieces) == sorted(lengths)
    assert len({p.sequence_id for p in pieces}) <= math.ceil(sum(lengths) / 4096) + 2


def test_run_and_empty_input(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), "test-empty")
    assert docs.count() == 0


def test_a_stage_leaves_what_a_live_result_reads(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lazy = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert corpus_pipeline.quality_rules(spark, docs, sf_dir).count() > 0
    assert corpus_pipeline.source_mix(spark, docs, sf_dir).count() > 0
    assert 0 < lazy.count() <= docs.count()


def test_two_runs_at_once_and_one_result_each(spark, sf_dir):
    from concurrent.futures import ThreadPoolExecutor

    from jetloom.sources.shared import shared_dir

    def tables():
        root = Path(shared_dir(spark).removeprefix("file://"))
        return {p.name for p in root.iterdir()} if root.exists() else set()

    before = tables()
    with ThreadPoolExecutor(2) as pool:
        counts = [df.count() for df in pool.map(lambda _: corpus_pipeline.run(spark, sf_dir), range(2))]
    assert counts[0] == counts[1] > 0
    assert sorted(n.rsplit("-", 1)[0] for n in tables() - before) == ["pipeline-best-fit-packing"] * 2


def test_near_dedup_goes_through_the_fingerprints_first(spark, monkeypatch):
    from jetloom.llm import near_copies, simhash

    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join([*words[:-1], "x"]), " ".join(words[:330]), " ".join(f"y{i}" for i in range(60))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    compare = near_copies._Groups.compare
    monkeypatch.setattr(near_copies._Groups, "compare", lambda self, pairs: (seen.append(pairs.count()), compare(self, pairs))[1])
    proposed = simhash.fingerprint_pairs(docs.withColumnRenamed("doc_id", "at"), 5).count()
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [0, 3]
    assert proposed > 0 and seen[0] == proposed
