"""Each operator of the subpackage against a plain version, on planted and hostile rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import textwrap
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

P = pytest.importorskip("public_tokenizers")
from jetloom.llm import chat, components, licenses, line_dedup, mixing, packing, quality, simhash, suffix_dedup, token_counts, tokenized, topk  # noqa: E402
from jetloom.llm.lcp_merge import common, front_coded, merged  # noqa: E402

#: Extra columns whose names clash with internal ones.
CLASHING = ["text", "row", "id", "key", "body", "size", "words", "content", "source_key", "digest"]


def hostile(spark):
    """Rows with nulls, empty and long texts, ties, repeated rows and clashing extra columns."""
    rng = random.Random(5)
    words = ["the", "of", "and", "Alpha", "beta,", "gamma.", "é", "日本", "###", "</turn>", "\\", "a|b"]
    long = " ".join(rng.choice(words) for _ in range(6000))
    same = " ".join(f"w{i}" for i in range(120))
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, long, "en", "a"), (4, long, "en", "a")]
    rows += [(None, same, "en", "b"), (5, same, "de", "b"), (6, same + " tail", "de", None)]
    rows += [(10 + i, "Shared Line here\n" + " ".join(rng.choice(words) for _ in range(80)) + f"\n  shared LINE here \nonly {i}", "en", rng.choice("abc")) for i in range(14)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING) if c != "text"}).withColumn("n_chars", F.length("text").cast("long"))


def pairs(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


# --- 2


def test_quality_counts(spark):
    df = hostile(spark)
    got = sorted(map(repr, pairs(quality.quality_report(df), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")))
    assert got == sorted(repr((d, *brute.quality(t))) for d, t in pairs(df, "doc_id", "text"))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "the", " ", "\n", "\t", "#", "|", "\x0b", "\u00a0", "é"]), max_size=90))
def test_quality_counts_any_text(spark, parts):
    df = spark.createDataFrame([(1, "".join(parts))], "doc_id long, text string")
    got = pairs(quality.quality_report(df), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == [brute.quality("".join(parts))]


def test_quality_filter_keeps_columns_and_clean_rows(spark):
    clean = " ".join(["the model of and to learn"] + [f"word{i} in the text{i}" for i in range(40)])
    junk = " ".join(f"w{i}***" for i in range(100))
    df = spark.createDataFrame([(1, clean, 7), (2, junk, 8), (3, None, 9)], "doc_id long, text string, row int")
    out = quality.quality_filter(df)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [(1, clean, 7)]
    assert quality.quality_filter(empty(spark)).count() == 0


# --- 3


def test_token_counts_equal_the_library_and_the_cache_is_used(spark, tmp_path):
    import sentencepiece

    df, path = hostile(spark), P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    want = sorted(repr((d, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096)) for d, t in pairs(df, "doc_id", "text"))
    cache = str(tmp_path / "cache")
    first = token_counts.token_counts(df, path, cache)
    assert sorted(map(repr, map(tuple, first.collect()))) == want
    n = spark.read.parquet(cache).count()
    assert n == df.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert sorted(map(repr, map(tuple, token_counts.token_counts(df, path, cache).collect()))) == want
    assert spark.read.parquet(cache).count() == n  # nothing was encoded again
    token_counts.token_counts(df.limit(2), P.path("byte_bpe_50k.json"), cache).collect()
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2
    assert token_counts.token_counts(empty(spark), path).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t▁aAzé日'.<s>/\u0301\x00 ")), max_size=30))
def test_chunked_counts(text):
    import sentencepiece

    global _SP
    try:
        sp, count = _SP
    except NameError:
        model = Path(P.path("piece_bpe_32k.model")).read_bytes()
        _SP = sp, count = sentencepiece.SentencePieceProcessor(model_proto=model), token_counts.sentencepiece_counter(model)
    assert count(text) == len(sp.encode(text))


def test_normalised_content_is_the_key(spark, tmp_path):
    from tokenizers import Tokenizer

    path, cache = P.path("word_bpe_49k.json"), str(tmp_path / "cache")
    texts = ["Some  Words", "some words", "SOME words ", "<|endoftext|> a", "<|ENDOFTEXT|> a", "é", "e\u0301", None, "", "some words"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokenizer = Tokenizer.from_file(path)
    want = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]
    for _ in range(2):
        assert [r.n_tokens for r in token_counts.token_counts(df, path, cache).orderBy("doc_id").collect()] == want
    stored = spark.read.parquet(cache).count()
    form = token_counts.normal_form(path, Path(path).read_bytes())
    assert stored == len({form(t or "") for t in texts}) < len({t or "" for t in texts})
    more = df.unionByName(spark.createDataFrame([(99, "quite new")], "doc_id long, text string"))
    assert token_counts.token_counts(more, path, cache).count() == len(texts) + 1
    assert spark.read.parquet(cache).count() == stored + 1


def test_normaliser_is_read_from_the_model():
    model = Path(P.path("piece_bpe_32k.model")).read_bytes()
    import sentencepiece

    sp, rules = sentencepiece.SentencePieceProcessor(model_proto=model), token_counts.sentencepiece_rules(model)
    probe = " a  Ａ\tﬁ b "
    assert (token_counts.normal_form("x.model", model) is None) == (sp.normalize(probe) == "▁" + probe.replace(" ", "▁"))
    assert rules["rule"] and set(rules) == {"rule", "mapped", "prefix", "squeezed", "escaped", "suffix"}


def test_memo_forgets_in_generations(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO_ENTRIES", 3)
    seen = []
    memo = token_counts.Memo(lambda k: seen.append(k) or len(k))
    for k in ["a", "bb", "ccc", "dddd", "a", "bb"]:
        assert memo[k] == len(k)
    assert seen == ["a", "bb", "ccc", "dddd"] and len(memo) <= 3


# --- 1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\tAaÉéİΣ日1½'-.,!<|>\u0301\u0331\x00\x1c\u00a0_s")), max_size=16), max_size=4))
def test_encoder_equals_the_library(texts):
    import pyarrow as pa
    from tokenizers import Tokenizer

    model = Path(P.path("word_bpe_49k.json")).read_bytes()
    global _TOK
    try:
        tok = _TOK
    except NameError:
        tok = _TOK = Tokenizer.from_buffer(model)
    texts = [*texts, "<|endoftext|> x<|ENDOFTEXT|>"]
    got = [np.frombuffer(b, "<u4").tolist() for b in tokenized.encoder("w", model)(pa.array(texts))]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_fast_path_rests_on_the_files_rules():
    import json

    model = json.loads(Path(P.path("word_bpe_49k.json")).read_bytes())
    model["model"]["vocab"], model["model"]["merges"] = {}, []
    assert tokenized.has_known_rules(json.dumps(model).encode())
    for change in ({"normalizer": None}, {"pre_tokenizer": None}, {"added_tokens": [model["added_tokens"][0] | {"content": "##"}]}):
        assert not tokenized.has_known_rules(json.dumps(model | change).encode())
    assert not tokenized.has_known_rules(Path(P.path("byte_bpe_50k.json")).read_bytes())


def check_packing(rows, want, capacity=4096):
    got, bins = {}, {}
    for r in rows:
        got.setdefault((r.doc_id, r.piece), []).append((r.start, r.length, r.ids_crc32))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {k: v[0] for k, v in got.items()} == want and all(len(set(v)) == 1 for v in got.values())
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return bins, sum(n for b in bins.values() for _, n in b)


def test_packing_places_every_piece_once(spark):
    from tokenizers import Tokenizer

    df, path = hostile(spark).repartition(3), P.path("word_bpe_49k.json")
    rows = packing.pack(df, path).collect()
    docs = pairs(df, "doc_id", "text")
    want = brute.pieces(docs, Tokenizer.from_file(path))
    bins, total = check_packing(rows, want)
    assert len(rows) == sum(len([k for k in want if k[0] == d]) for d, _ in docs)
    assert len(bins) <= math.ceil(total / 4096) + 1
    assert packing.pack(empty(spark), path).count() == 0


def test_packing_many_nodes_stays_near_the_bound(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.lit("the"), (F.col("id") * 37 % 900 + 1).cast("int"))).alias("text")).repartition(20)
    rows = packing.pack(docs, P.path("word_bpe_49k.json"), fan_in=3).collect()
    total, used = sum(r.length for r in rows), len({r.sequence_id for r in rows})
    assert len(rows) == 600 and used <= math.ceil(total / 4096) + 2


def test_packing_in_several_runs(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.lit("the"), (F.col("id") * 53 % 800 + 1).cast("int"))).alias("text")).repartition(6)
    found = [packing.pack(docs, P.path("word_bpe_49k.json"), fan_in=2, run_pieces=n).collect() for n in (7, 10**6)]
    for rows in found:
        bins, total = check_packing(rows, {(r.doc_id, 0): (0, r.length, r.ids_crc32) for r in rows})
        assert len(rows) == 500 and len(bins) <= math.ceil(total / 4096) + 2


def merged_up(leaves, capacity, fan_in, most):
    """Bins that come out of the tree when nodes hand up ``most`` bins; each leaf is a list of sizes."""
    nodes, closed = [[[{"length": n}] for n in leaf] for leaf in leaves], 0
    first = True
    while first or len(nodes) > 1:
        if not first:
            nodes = [sum(nodes[i : i + fan_in], []) for i in range(0, len(nodes), fan_in)]
        first, up = False, []
        for bins in nodes:
            rows = packing._packed(bins, 0, 0, 0, capacity, 0, most, False)
            closed += sum(r["closed"] for r in rows)
            up.append([r["items"] for r in rows if not r["closed"]])
        nodes = up
    return closed + len(nodes[0])


def test_handing_up_the_emptiest_bins_costs_no_sequence():
    rng = random.Random(6)
    for fan_in in (2, 3, 8):
        for _ in range(15):
            leaves = [[rng.choice((rng.randint(1, 1000), rng.randint(500, 700))) for _ in range(rng.randint(1, 400))] for _ in range(rng.randint(2, 12))]
            assert merged_up(leaves, 1000, fan_in, packing.handed_up(fan_in)) <= merged_up(leaves, 1000, fan_in, 10**9) + 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit(sizes):
    bins = packing.best_fit(sizes, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    fills = [sum(sizes[i] for i in b) for b in bins]
    assert all(f <= 50 for f in fills) and sum(f <= 25 for f in fills) <= 1


# --- 4


def test_mix_equals_plain_version(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", "é", "𝔸", None, "huge", "huge", "huge"]), " ".join(["w"] * rng.randint(0, 300))) for i in range(400)]
    rows += [(1000, "tiny", "one two three"), (1001, "none", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns({"key": F.lit(1), "size": F.lit("x")})
    want = brute.mix(rows)
    out = mixing.mix(df, block_words=64)
    got = {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in out.collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k][:2] == v[:2] and got[k][2] == pytest.approx(v[2]) and got[k][3] == v[3]
    text = {d: t for d, _, t in rows}
    mixed = mixing.mixed(df, block_words=64)
    assert mixed.columns == df.columns
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(brute.WORDS.findall(r.text))
        assert text[r.doc_id].startswith(r.text)
    assert words == {k: v[3] for k, v in want.items() if v[3]}


def three_sources(spark):
    sizes = spark.createDataFrame([("sa", "a", 300000), ("sb", "b", 300000), ("sc", "c", 300000), ("sd", "d", 7)], "source_key string, source string, size long")
    return mixing.source_targets(sizes)


def test_schedule_spreads_sources(spark):
    targets = {r.source_key: r.limit for r in three_sources(spark).collect()}
    slots = mixing.schedule(three_sources(spark), 100).orderBy("position").collect()
    n, every = len(slots), {k: sum(r.source_key == k for r in slots) for k in targets}
    assert {k: sum(r.words for r in slots if r.source_key == k) for k in targets} == targets
    assert len({r.position for r in slots}) == n
    late = [r for r in slots if r.position >= n]
    assert len(late) <= len(targets) * (math.log2(n) * 2 / 3 + 3)  # what follows the schedule is bounded
    for upto in range(200, n, 371):  # every beginning of the mix has the targets' shares
        for k in targets:
            assert abs(sum(r.source_key == k for r in slots[:upto]) - upto * every[k] / n) <= math.log2(n) * 2 / 3 + 3
    for k in targets:  # ranks counted from digits are those of the order
        assert [r.rank for r in slots if r.source_key == k] == list(range(every[k]))


def test_without_the_points_the_mix_misses_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "radical_inverse", lambda k: k.cast("long"))  # all near 0: one source takes every slot
    got = mixing.schedule(three_sources(spark), 100).groupBy("source_key").agg(F.sum("words").alias("n")).collect()
    want = {r.source_key: r.limit for r in three_sources(spark).collect()}
    assert {r.source_key: r.n for r in got} != want


def van_der_corput(k):
    return sum(((k >> i) & 1) / 2 ** (i + 1) for i in range(48))


@pytest.mark.parametrize("x", [0, 1, 3 << 46, (1 << 47) + 12345, (1 << 48) - 1, 1 << 48])
def test_points_below_are_counted_from_digits(spark, x):
    df = spark.range(300).select("id", mixing.radical_inverse(F.col("id")).alias("u"), mixing._counted(F.col("id"), mixing._steps(F.lit(x).cast("long"))).alias("n"))
    rows = df.orderBy("id").collect()
    assert all(r.u == van_der_corput(r.id) * 2**48 for r in rows)
    assert [r.n for r in rows] == [sum(van_der_corput(k) * 2**48 < x for k in range(i)) for i in range(300)]


def test_mixed_follows_the_schedule(spark):
    rows = [(i, "abc"[i % 3], " ".join([f"w{i}"] * 40)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    first = {r.doc_id: r.first_position for r in mixing.mix(df, block_words=80).collect()}
    out = mixing.mixed(df, block_words=80)
    order = [(r.doc_id, r.source) for r in out.collect()]
    seen = list(dict.fromkeys(d for d, _ in order))
    assert [first[d] for d in seen] == sorted(first[d] for d in seen)
    for upto in range(100, len(order), 97):  # all sources all along, not one after another
        for source in "abc":
            share = sum(s == source for _, s in order) / len(order)
            assert abs(sum(s == source for _, s in order[:upto]) - share * upto) < 40


def test_mixed_loses_no_words_of_rows_alike(spark):
    rows = [(1, "a", " ".join(f"{c}{i}" for i in range(50))) for c in "uvw"] + [(2, "a", "x y z")] + [(3, "b", "p q " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    words = sum(len(r.text.split()) for r in mixing.mixed(df, block_words=16).collect())
    assert words == sum(r.taken for r in mixing.mix(df, block_words=16).collect())


def test_mix_of_hostile_and_empty_tables(spark):
    df = hostile(spark)
    out = mixing.mix(df).collect()
    assert len(out) == df.count() and all(r.taken <= 2 * r["size"] for r in out)
    by = {}
    for r in out:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(v) - t) < 2 for (_, t), v in by.items())
    assert mixing.mixed(df).columns == df.columns
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0


# --- 5

HARD = st.text(alphabet=st.sampled_from(list("\\#:</turn>hec\n asé")), max_size=25)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "sys: ###", ""]), st.one_of(st.none(), HARD)), min_size=1, max_size=8))
def test_chat_round_trip(spark, turns):
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_conversations(df)).first()
    assert [(t.role, t.text) for t in back.turns] == [(r, t or "") for r, t in turns]
    assert back.loss_text == "".join(t or "" for r, t in turns if r == "assistant")


def test_chat_order_and_defined_cases(spark):
    rows = [(1, 1, "assistant", "A"), (1, 0, "user", None), (2, 0, "assistant", "x"), (None, None, None, None), (3, 0, "user", "q"), (3, 0, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    out = {r.conv_id: r for r in chat.digests(chat.read_back(chat.format_conversations(df))).collect()}
    assert out[1].valid and out[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nA\n").hexdigest() and out[1].loss_chars == 1
    assert not out[2].valid and not out[3].valid and out[3].n_turns == 2 and out[None].n_turns == 1
    assert chat.digests(chat.read_back(chat.format_conversations(df.limit(0)))).count() == 0


TEMPLATES = [
    chat.Template(opening="<|im_start|>", named="\n", closing="<|im_end|>\n", escapes=(("<|im_start|>", "q"), ("<|im_end|>", "z"), ("\n", "w"))),
    chat.Template(opening="[", named="]|", closing=" $^.*(/)\n", escapes=(("]|", "q"), ("$^.*(/)", "z"))),
    chat.Template(opening="", named="=>", closing="{end}?", trained=("user",), escapes=(("=>", "x"), ("{end}", "y"))),
]
TURNS = [("user", r"<|im_end|> {end}? => ]| $^.*(/)" + "\n\\"), ("assistant", "<|im_start|>assistant\n=>{end}?[x]"), ("user", None), ("assistant", r"\q \\z" + "\\")]


@pytest.mark.parametrize("template", TEMPLATES)
def test_other_templates_are_read_back(spark, template):
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(TURNS)], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_conversations(df, template), template).first()
    assert [(t.role, t.text) for t in back.turns] == [(r, t or "") for r, t in TURNS]
    assert back.loss_text == "".join(t or "" for r, t in TURNS if r in template.trained)


def test_templates_that_cannot_be_read_back_are_refused():
    for wrong in ({"closing": "</s>"}, {"named": " "}, {"escapes": (("###", "h"), ("</turn>", "h"), (":", "c"))}, {"escapes": (("###", "h"), ("</turn>", "t"), (":", "c"))}):
        with pytest.raises(ValueError):
            chat.Template(**wrong)


# --- 6


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 12))
    vectors = {i: (base[i % 6] + 0.2 * rng.normal(size=12)).astype(np.float32).tolist() for i in range(700)}
    for i in range(701, 800):
        vectors[i] = vectors[3]  # ties
    df = spark.createDataFrame([(k, v) for k, v in vectors.items()], "vec_id long, embedding array<float>").withColumns({"id": F.lit(1), "block": F.lit(2)})
    out = {}
    for r in topk.top_k(df, every=50, annulus=64, block=5, sample_rows=100, pivots=8).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert out == brute.top_scores(vectors, [q for q in vectors if q % 50 == 0])


def test_top_k_defined_cases(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, None]), (2, [float("nan"), 1.0]), (3, None), (4, [float("inf"), 1.0]), (None, [1.0, 2.0]), (5, [3.0]), (6, [1e30, 1.0]), (7, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = [(r.rank, r.vec_id, r.score) for r in topk.top_k(df).orderBy("rank").collect()]
    assert out[0][1] == 6
    assert [(v, s) for _, v, s in out[1:]] == [(None, 5 * 1024**2), (5, 3 * 1024**2), (7, 0)]
    assert topk.top_k(df.where("vec_id = 0")).count() == 0 and topk.top_k(df.limit(0)).count() == 0


# --- 7


def test_license_rules_in_order(spark):
    S = licenses.SENTENCES
    rows = [
        (1, "Intro.\nReleased under the MIT License.\nAll rights reserved."),
        (2, "Licensed under the Apache License, Version 2.0 (the License);\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n" + S["apache-asis"] + "."),
        (3, None), (4, ""), (5, "All my software rights! reserved"), (6, "Licensed under CC BY-NC 4.0."),
    ]
    out = {r.doc_id: (r.sentence_ids, r.licenses) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1] == ("mit-notice reserved", "MIT Proprietary")
    assert out[2] == ("apache-notice-the apache-use apache-copy apache-asis", "Apache-2.0")
    assert out[3] == out[4] == out[5] == ("", "") and out[6][1] == "CC-BY-NC-4.0"
    assert licenses.license_scan(hostile(spark)).count() == hostile(spark).count() and licenses.license_scan(empty(spark)).count() == 0


def scanned(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.sentence_ids, r.licenses) for r in licenses.license_scan(df, **options).orderBy("doc_id").collect()]


def test_wrapped_license_texts(spark):
    S = {k: v.strip("* ") for k, v in licenses.SENTENCES.items()}
    wrap = lambda *names: "\n\n".join(textwrap.fill(S[n].capitalize() + ".", 72) for n in names)
    grant, gpl = wrap("mit-grant", "mit-keep"), "This program is free software: " + S["gpl-terms"] + "."
    texts = ["MIT License\n\nCopyright (c) 2020 A\n\n" + grant, textwrap.fill(gpl, 70), grant.replace("\n", "\r\n")]
    texts += [f"{m} " + grant.replace("\n", f"\n{m} ") for m in ("#", "//", "--", " *", ";;")]
    texts += ["Released under\n\nthe MIT License.", "It is released under the\nMIT License.", "/* Released under the\n * MIT License */\nint x;"]
    mit = ("mit-grant mit-keep", "MIT")
    assert scanned(spark, texts) == [mit, ("gpl-free gpl-terms", "GPL-3.0-or-later"), mit] + 5 * [mit] + [("", "")] + 2 * [("mit-notice", "MIT")]


def test_every_identifier_is_reached(spark):
    S = licenses.SENTENCES
    written_as = lambda s: s.strip("* ").replace("spdx-license-identifier ", "SPDX-License-Identifier: ")
    texts = [f"Intro.\n{written_as(s)}\nMore text." for s in S.values()]
    assert [ids for ids, _ in scanned(spark, texts)] == list(S)
    tags = ["// SPDX-License-Identifier: MIT", "/* SPDX-License-Identifier: GPL-3.0-only */", "<!-- SPDX-License-Identifier:Apache-2.0 -->\n<p>"]
    assert [licence for _, licence in scanned(spark, tags)] == ["MIT", "GPL-3.0-only", "Apache-2.0"]


def test_prefilter_follows_the_table(spark):
    assert scanned(spark, ["All  rights\treserved.", "ALL RIGHTS\nRESERVED"]) == 2 * [("reserved", "Proprietary")]
    known, rules = {"own": "do as you like", "b": "x y"}, (("Own", ("own",)), ("B", ("b",)))
    assert scanned(spark, ["Do as you like.", "X\tY", "all rights reserved"], known=known, rules=rules) == [("own", "Own"), ("b", "B"), ("", "")]
    for table in (licenses.SENTENCES, known):
        assert all(any(w in s for w in licenses.key_words(table)) for s in map(licenses.phrase, table.values()))


def test_taken_identifiers_leave_a_gap(spark):
    S = licenses.SENTENCES
    sentence = lambda *names: ".\n\n".join(S[n].strip("* ") for n in names) + "."
    apart, twice, mixed = sentence("mit-grant", "apache-notice", "mit-keep"), sentence("mit-notice", "mit-notice", "mit-notice"), sentence("bsd-grant", "bsd-source", "bsd-binary", "reserved")
    assert [x for _, x in scanned(spark, [apart, twice, mixed])] == ["Apache-2.0", "MIT", "BSD-2-Clause Proprietary"]
    rules = (("Pair", ("a", "b")), ("Alone", ("b",)), ("Other", ("a", "c")))
    known = {"a": "one", "b": "two", "c": "three"}
    # the pair is taken out of a a b c, and its neighbours do not become one
    assert scanned(spark, ["one. one. two. three."], known=known, rules=rules) == [("a a b c", "Pair")]


def test_other_words_in_the_sentence(spark):
    texts = ["This project is released under the MIT License.", "Copyright 2020 X. All rights reserved by X.", "(c) 2020 Y, all rights reserved.", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."]
    assert [ids for ids, _ in scanned(spark, texts)] == ["mit-notice", "", "reserved", "mpl2-copy"]


def plain_scan(text, known, rules):
    """By the method's words: pieces between hard ends, their words line by line, the longest known sentence at each place; then the rules."""
    low = brute.lower(text).replace("|", " ").replace("~", " ")
    ids = []
    for piece in re.split(r"[.!?]+(?=[ \t-\r])|[:;]+|\n[ \t\x0b-\r]*\n", low + "\n"):
        words = [(w, i == 0, i + 1 == len(line)) for line in (re.findall(r"[a-z0-9./-]+", x) for x in piece.split("\n")) for i, w in enumerate(line)]
        at = 0
        while at < len(words):
            for name, pattern in sorted(known.items(), key=lambda x: -len(x[1].strip("* "))):
                own = pattern.strip("* ").split(" ")
                run = words[at : at + len(own)]
                if [w for w, _, _ in run] == own and (pattern[0] == "*" or run[0][1]) and (pattern[-1] == "*" or run[-1][2]):
                    ids.append(name)
                    at += len(own)
                    break
            else:
                at += 1
    left, hits = list(ids), []
    for name, run in rules:
        at = 0
        while at + len(run) <= len(left):
            if tuple(left[at : at + len(run)]) == run:
                left[at : at + len(run)] = [None] * len(run)
                hits += [name] * (name not in hits)
                at += len(run)
            else:
                at += 1
    order = list(dict.fromkeys(n for n, _ in rules))
    return " ".join(ids), " ".join(sorted(hits, key=order.index))


PHRASES = ["one two", "two three", "four", "one two three", "five six", "seven", "x", "one", "three"]
KNOWN = {"a": "one two", "b": "* two three", "c": "four", "d": "five six *", "e": "one two three", "f": "* seven"}
SMALL_RULES = (("L1", ("a", "c")), ("L2", ("c", "c")), ("L3", ("e",)), ("L1", ("d", "f")), ("L4", ("b",)), ("L5", ("c",)))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(PHRASES), st.sampled_from([". ", "\n", "\n\n", " ", "; ", ": ", ", ", "! ", " (", "."])), max_size=14), min_size=1, max_size=12))
def test_scan_equals_plain_version(spark, texts):
    texts = ["".join(p.upper() if i % 3 else p + e for i, (p, e) in enumerate(t)) if len(t) % 2 else "".join(p + e for p, e in t) for t in texts]
    assert scanned(spark, texts, known=KNOWN, rules=SMALL_RULES) == [plain_scan(t, KNOWN, SMALL_RULES) for t in texts]


def test_scan_of_the_table_equals_plain_version(spark):
    rng = random.Random(11)
    S = [v.strip("* ") for v in licenses.SENTENCES.values()]
    texts = ["".join(textwrap.fill(rng.choice(S).capitalize(), 60) + rng.choice([".\n", ".\n\n", "; ", "\n\n", ". And so on. "]) for _ in range(rng.randint(1, 9))) for _ in range(150)]
    assert scanned(spark, texts) == [plain_scan(t, licenses.SENTENCES, licenses.RULES) for t in texts]


# --- 8


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6), max_size=20), min_size=1, max_size=7))
def test_loser_tree_merges_with_prefixes(runs):
    coded = [front_coded((k, b"p") for k in sorted(r)) for r in runs]
    out = list(merged(coded))
    assert [k for _, k, _ in out] == sorted(k for r in runs for k in r)
    last = None
    for shared, k, _ in out:
        assert last is None or shared == common(last, k)
        last = k


def test_anchors_depend_on_content_alone():
    rng = np.random.default_rng(0)
    a = rng.integers(97, 110, 3000, np.uint8).tobytes()
    b = b"x" * 37 + a[500:1500] + b"tail"
    mine = {int(p) - 500: int(g) for p, g, lo, hi in zip(*suffix_dedup.anchors(a, 200, 64), strict=True) if lo >= 500 and hi + 200 <= 1500}
    yours = {int(p) - 37: int(g) for p, g, *_ in zip(*suffix_dedup.anchors(b, 200, 64), strict=True)}
    assert mine and mine.items() <= yours.items()
    pos, _, lo, hi = suffix_dedup.anchors(a, 200, 64)
    assert lo[0] == 0 and hi[-1] == 2800 and (lo[1:] == hi[:-1] + 1).all() and ((pos >= hi) & (pos <= lo + 136)).all()


def test_suffix_dedup_equals_brute_force(spark):
    rng = random.Random(8)
    letters = lambda n, k="abcdefgh é日": "".join(rng.choice(k) for _ in range(n))
    passage, block = letters(260), letters(199)
    rows = [(i, letters(rng.randint(0, 400)) + passage[rng.randint(0, 70):] + letters(rng.randint(0, 300))) for i in range(25)]
    rows += [(100, block + "x"), (101, block + "y"), (102, "ab" * 400), (103, "z" * 250), (104, "z" * 199), (105, rows[0][1]), (106, None), (107, ""), (108, passage + passage), (None, rows[1][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "at": F.lit(2), "body": F.lit("q")}).repartition(3)
    want = brute.suffix_dedup([(d if d is not None else -1, t) for d, t in rows])
    got = {(-1 if r.doc_id is None else r.doc_id): (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup_report(df).collect()}
    assert got == want
    assert suffix_dedup.suffix_dedup_report(empty(spark)).count() == 0
    assert suffix_dedup.suffix_dedup_report(hostile(spark)).count() == hostile(spark).count()


def strings_of(rows, length):
    """Per (suffix, payload): for each d, whether its string occurs twice in all rows."""
    from collections import Counter

    of = lambda s, p: {d: p[2 : 2 + d][::-1] + s[: length - d] for d in range(p[0], p[1] + 1)}
    n = Counter(x for s, p in rows for x in of(s, p).values())
    return {(s, p): {d for d, x in of(s, p).items() if n[x] > 1} for s, p in rows}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 4))
def test_ranges_that_cut_classes_give_the_same_verdicts(seed, n_splitters):
    rng, length, gram = random.Random(seed), 12, 6
    pick = lambda n: bytes(rng.choice(b"ab") for _ in range(n))
    rows = []
    for _ in range(rng.randint(1, 40)):  # one frequent gram, contexts of few letters
        lo = rng.randint(0, 3)
        hi = rng.randint(lo, 6)
        suffix, back = b"gggggg" + pick(length - 6 - lo), pick(hi)
        rows.append((suffix, bytes((lo, hi)) + back))
    keys = sorted(set(rows))
    splitters = sorted(rng.sample(keys, min(n_splitters, len(keys))))
    cuts = [0, *[sum(k < s for k in keys) for s in splitters], len(keys)]
    ends = [None, *[s for s, _ in splitters], None]
    found, cut = {}, []
    for k in range(len(cuts) - 1):
        part = keys[cuts[k] : cuts[k + 1]]
        run = front_coded((s, bytes((min(2, rows.count((s, p))),)) + p) for s, p in part)
        v = suffix_dedup.verdicts([run], length, gram, ends[k], ends[k + 1])
        for digest, mask in v.decided:
            found.setdefault(digest, set()).update(np.flatnonzero(np.unpackbits(np.frombuffer(mask, np.uint8))).tolist())
        cut += v.cut
    for string, n, digest, d in cut:
        if n == 1 and sum(m for s, m, _, _ in cut if s == string) > 1:
            found.setdefault(digest, set()).add(d)
    want = strings_of(rows, length)
    assert {suffix_dedup._digest(*k): v for k, v in want.items() if v} == found


@pytest.mark.parametrize("text_sample", [8, 10**9])
def test_a_frequent_gram_is_spread_over_ranges(spark, monkeypatch, text_sample):
    monkeypatch.setattr(suffix_dedup, "SAMPLE_TEXTS", text_sample)
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = letters(90)  # shorter than the strings: frequent, but repeated only with its surroundings
    rows = [(i, letters(rng.randint(150, 260)) + passage + letters(rng.randint(150, 260))) for i in range(160)]
    rows += [(200 + i, rows[i][1][40:-30] + letters(60)) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute.suffix_dedup(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup_report(df).collect()} == want
    assert sum(x[1] > 0 for x in want.values()) >= 24


# --- 9


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("block", [64, 8, 2])
def test_links_join_the_same_components(spark, block):
    rng = random.Random(4)
    fps = set()
    for _ in range(60):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(rng.randint(0, 6)):
            for _ in range(rng.randint(1, 3)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << rng.randrange(42, 64)) ^ (1 << rng.randrange(64)) for _ in range(150)}  # many share segments
    ids = {i: f for i, f in enumerate(sorted(fps))}
    nodes = spark.createDataFrame([(signed(f),) for f in ids.values()], "fp long")
    found = simhash.links(nodes, block)
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in pairs(found, "u", "v"))
    roots = dict(pairs(components.stars(found), "node", "root"))
    group = {}
    for i, f in ids.items():
        group.setdefault(roots.get(signed(f), signed(f)), set()).add(i)
    want = {}
    for i, c in brute.components(ids).items():
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, group.values())) == sorted(map(sorted, want.values()))


def test_simhash_equals_brute_force(spark):
    df = hostile(spark)
    rows = [(d, t) for d, t in pairs(df, "doc_id", "text") if d is not None]
    fps = {d: brute.fingerprint(t) for d, t in rows}
    want = brute.components(fps)
    out = simhash.near_duplicates(df).collect()
    assert len(out) == df.count()
    for r in out:
        if r.doc_id is not None:
            assert (int(r.fingerprint, 16), r.component_id) == (fps[r.doc_id], want[r.doc_id])
        else:
            assert r.component_id == 5  # the null id's copy
    kept = simhash.one_of_each(df, words=3, similarity=None)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} - {None} == set(want.values())
    assert simhash.near_duplicates(empty(spark)).count() == 0
    for least in (None, 0.8):
        assert simhash.one_of_each(empty(spark), similarity=least).count() == 0


@pytest.mark.parametrize("least", [None, 0.8])
def test_repeated_ids_with_different_texts_all_stay(spark, least):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    df = spark.createDataFrame([(2, b), (4, a), (4, b), (None, c), (None, a)], "doc_id long, text string")
    kept = sorted((r.text, r.doc_id) for r in simhash.one_of_each(df, similarity=least).collect())
    assert kept == sorted([(a, 4), (b, 2), (c, None)], key=lambda x: x[0])


def test_simhash_leaves_one_of_null_ids_and_repeated_rows(spark):
    same, other = " ".join(f"w{i}" for i in range(50)), " ".join(f"v{i}" for i in range(50))
    df = spark.createDataFrame([(None, same), (None, same), (7, other), (7, other), (None, other), (9, other)], "doc_id long, text string")
    assert sorted(((r.doc_id, r.text) for r in simhash.one_of_each(df, words=3, similarity=None).collect()), key=str) == [(7, other), (None, same)]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "u long, v long")
    roots = dict(pairs(components.stars(edges), "node", "root"))
    assert {roots[i] for i in range(61)} == {0} and roots[101] == 100 and 7 in roots


# --- 10


@pytest.mark.parametrize("few", [1 << 18, 0])
@pytest.mark.parametrize("first", [False, True])
def test_line_dedup_equals_brute_force(spark, few, first):
    df = hostile(spark)
    rows = [(d, t) for d, t in pairs(df, "doc_id", "text") if d is not None]
    for least in (2, 10):
        out = line_dedup.line_dedup_report(df.where("doc_id is not null"), min_docs=least, keep_first=first, filter_bits=1 << 19, broadcast_keys=few)
        assert sorted(map(tuple, out.collect())) == sorted(brute.line_dedup(rows, least, 1, first))
    assert line_dedup.line_dedup_report(df, broadcast_keys=few, filter_bits=1 << 19).count() == df.count()
    assert line_dedup.line_dedup_report(empty(spark), filter_bits=1 << 19).count() == 0


def test_filters_follow_the_number_of_lines(spark):
    df = spark.createDataFrame([("a\nb\nc",), ("",), ("\n".join("x" * 200_000),)], "body string")
    lines = 3 + 1 + 200_000
    assert line_dedup.filter_size(df) == 1 << math.ceil(math.log2(8 * lines + 1)) and line_dedup.filter_size(df.limit(0)) == line_dedup.MIN_FILTER_BITS


def test_a_block_ends_its_scan_at_the_bound():
    q = np.array([[3.0, 4.0]])
    row = {"q_ids": np.array([1], "<i8").tobytes(), "q_vectors": topk._pack(q), "least": np.array([20], "<i8").tobytes()}
    state = topk._Search(row, np.array([[3.0, 4.0, 0.0]]), 2, 25.0, 1)
    far = state.reach.max()
    assert not state.ended(far * 0.99) and state.ended(far * 1.01)
    state.ring({"pivot": 0, "lo": 0.0, "hi": 0.1, "ids": np.array([7, 8, 9], "<i8").tobytes(), "vectors": topk._pack(np.array([[3.0, 4.0], [4.0, 3.0], [3.0, 3.0]]))})
    assert state.ended(far * 0.99)  # better scores have shrunk the ring


def test_line_dedup_with_a_full_filter_is_still_exact(spark):
    rows = [(i, "\n".join([f"line {i} {k}" for k in range(3000)] + ["common", "Common "])) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = line_dedup.line_dedup_report(df, filter_bits=1 << 19)
    assert sorted(map(tuple, out.collect())) == sorted(brute.line_dedup(rows))
