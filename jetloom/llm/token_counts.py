"""Token counts through a digest cache.

The cache is a Parquet table (content digest, n_tokens) in one folder for each tokenizer
digest. A call joins the digests of its texts to it, encodes each missing text once, appends
the new counts and joins them back. Only texts whose digest is missing are shuffled.

Content is keyed by SHA-256 of its normal form: what the tokenizer's own normaliser makes
of the whole text, and no more, so texts of one key always have one count. Where
the normaliser changes nothing, the digest is made without Python; a text that holds an
added token's string is keyed as it is, because such strings are cut out before normalising.

Defined results: a null text counts as empty (0 bytes, 0 tokens); null ids are
carried through; repeated rows each get a row; an empty table gives an empty
result. Rows appended twice by concurrent calls are harmless: a digest is read once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_path, sliced, text_or_empty, written

#: Entries of a generation of a worker's memo of encoded chunks; two are kept.
MEMO_ENTRIES = 200_000
#: Longer chunks are encoded without being remembered.
MEMO_CHARS = 48
#: A tokenizer file goes to the workers whole, so its size is bounded.
MAX_TOKENIZER_BYTES = 64 << 20


class Memo(dict):
    """chunk -> value, computed when first asked for. When full it keeps one older generation, from which used chunks return."""

    def __init__(self, compute: Callable):
        super().__init__()
        self.compute = compute
        self.older: dict = {}

    def knows(self, chunk) -> bool:
        return chunk in self or chunk in self.older

    def put(self, chunk, value) -> None:
        if len(chunk) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[chunk] = value

    def __missing__(self, chunk):
        value = self.older.get(chunk)
        if value is None:
            value = self.compute(chunk)
        self.put(chunk, value)
        return value


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer's fields: whole numbers and byte strings (fixed-width values as bytes)."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        yield key >> 3, message[at : at + size]
        at += size


def sentencepiece_rules(model: bytes) -> dict:
    """What the model says of normalisation: its rule's name, whether it has a character map, and its treatment of white space."""
    # fixed values: numbers of the public message's fields
    normaliser, trainer, name, char_map, prefix, squeeze, escape, suffix = 3, 2, 1, 2, 3, 4, 5, 24
    spec = dict(_fields(b"".join(v for n, v in _fields(model) if n == normaliser)))
    train = dict(_fields(b"".join(v for n, v in _fields(model) if n == trainer)))
    return {
        "rule": spec.get(name, b"").decode(),
        "mapped": bool(spec.get(char_map)),
        "prefix": bool(spec.get(prefix, 1)),
        "squeezed": bool(spec.get(squeeze, 1)),
        "escaped": bool(spec.get(escape, 1)),
        "suffix": bool(train.get(suffix, 0)),
    }


def _changes_nothing(model: bytes) -> bool:
    """Whether the normal form is the text itself, with a space mark before it and for each space."""
    r = sentencepiece_rules(model)
    return not r["mapped"] and r["prefix"] and not r["squeezed"] and r["escaped"] and not r["suffix"]


def sentencepiece_counter(model: bytes) -> Callable[[str], int]:
    """Tokens of a text, as the library counts them.

    Merges never join a character to a space mark after it unless a piece has a
    mark inside; where no piece has, a text falls into independent chunks (space
    marks, then other characters) and chunk counts can be remembered and added.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    mark = "▁"
    inner = re.compile(f"[^{mark}]{mark}")
    if not _changes_nothing(model) or any(inner.search(sp.id_to_piece(i)) for i in range(sp.get_piece_size())):
        return lambda text: len(sp.encode(text))
    chunks = re.compile(f"{mark}+[^{mark}]*").findall

    def count(chunk: str) -> int:  # the library itself puts a mark in front
        return 1 if chunk == mark else len(sp.encode(chunk[1:]))

    by_chunk = Memo(count)
    by_word = Memo(lambda word: len(sp.encode(word)))

    def total(text: str) -> int:
        if not text:
            return 0
        if mark not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return sum(map(by_word.__getitem__, text.split(" ")))
        return sum(map(by_chunk.__getitem__, chunks(mark + text.replace(" ", mark))))

    return total


def normal_form(name: str, model: bytes) -> Callable[[str], str] | None:
    """text -> its normal form; None where that is the text itself."""
    if name.endswith(".model"):
        if _changes_nothing(model):
            return None
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=model).normalize
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(model)
    if tokenizer.normalizer is None:
        return None
    normalise, added = tokenizer.normalizer.normalize_str, [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def form(text: str) -> str:
        made = normalise(text)
        return "raw:" + text if any(a in made or a in text for a in added) else "normal:" + made

    return form


def tokenizers_counter(model: bytes) -> Callable[[str], int]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(model)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def counter(name: str, model: bytes) -> Callable[[str], int]:
    return sentencepiece_counter(model) if name.endswith(".model") else tokenizers_counter(model)


def tokenizer_bytes(path: str) -> bytes:
    model = Path(path).read_bytes()
    if len(model) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path}: a tokenizer file may have {MAX_TOKENIZER_BYTES} bytes at most")
    return model


def _cached(spark, cache_path: str, version: str) -> DataFrame | None:
    """content, n_tokens of a tokenizer's folder of the cache."""
    try:
        return spark.read.schema("content binary, n_tokens long").parquet(f"{cache_path}/tokenizer={version}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def _with_content(rows: DataFrame, name: str, model: bytes, shipped) -> DataFrame:
    """``rows`` (with ``body``) and ``content``, the digest of the body's normal form."""
    if normal_form(name, model) is None:
        return rows.withColumn("content", F.unhex(F.sha2("body", 256)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = normal_form(name, shipped.value)
        for batch in sliced(batches):
            made = [hashlib.sha256(form(t).encode()).digest() for t in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], [*batch.schema.names, "content"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("content", T.BinaryType())]))


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str | None = None,
    id_col: str = "doc_id",
    text: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every document; new counts are appended to ``cache_path``.

    Without ``cache_path`` the cache lives in a new table of the shared folder.
    """
    spark = docs.sparkSession
    model = tokenizer_bytes(tokenizer_path)
    version = hashlib.sha256(model).hexdigest()
    cache_path = cache_path or fresh_path(spark, "token-counts")
    shipped, name = spark.sparkContext.broadcast(model), tokenizer_path

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(name, shipped.value)
        for batch in sliced(batches):
            counts = [count(t) for t in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    body = text_or_empty(text).alias("body")
    texts = _with_content(docs.select(body), name, model, shipped)
    known = _cached(spark, cache_path, version)
    if known is not None:  # digests alone meet the cache; only texts that it lacks are shuffled
        lacking = written(texts.select("content").distinct().join(known, "content", "left_anti"), "token-counts-missing", few_files=True)
        texts = texts.join(lacking, "content", "left_semi")
    # one text per digest: copies meet within a task before anything is shuffled
    misses = texts.select("content", "body").dropDuplicates(["content"])
    misses.mapInArrow(encode, "content binary, n_tokens long").write.mode("append").parquet(f"{cache_path}/tokenizer={version}")

    size = F.octet_length("body").cast("long").alias("n_bytes")
    rows = _with_content(docs.select(F.col(id_col).alias("id"), body), name, model, shipped).select("id", size, "content")
    stored = _cached(spark, cache_path, version)
    if known is not None:  # of a cache with a history, what this call asks for
        stored = stored.join(rows.select("content").distinct(), "content", "left_semi")
    # written, so that Spark can split the tasks of a digest that very many rows have
    counts = written(stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens")), "token-counts-read", few_files=True)
    return rows.join(counts, "content", "left").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
