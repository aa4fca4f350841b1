"""Token ids of whole texts as bytes: each chunk between white space is encoded once per group of texts."""

from __future__ import annotations

import json
import os
import struct
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .token_counts import Memo

_ENCODERS: dict[str, Callable[[pa.Array], Iterator[bytes]]] = {}
#: ASCII signs that are neither letters nor digits (white space is never in a chunk).
_SIGNS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
#: Bytes of text that are encoded together (a longer text is a group of its own).
GROUP_BYTES = 6 << 20


def parts(chunk: str) -> tuple[str, str]:
    """(head, last signs) where the head is letters alone and stays so when normalised: then a pre-token ends there. Else (chunk, "")."""
    head = chunk.rstrip(_SIGNS)
    stays = head.isalpha() and (head.isascii() or (head.lower().isalpha() and unicodedata.is_normalized("NFC", head)))
    return (head, chunk[len(head) :]) if stays else (chunk, "")


def plain_word(head: str) -> str | None:
    """The head as the normaliser leaves it, if it is letters alone and that is certain without asking; else None."""
    if not head.isalpha():
        return None
    if head.isascii():
        return head.lower()
    return head if head == head.lower() and unicodedata.is_normalized("NFC", head) else None


def _bytes_as_letters() -> dict[int, int]:
    """Latin-1 character -> the character by which byte-level vocabularies write that byte: itself if visible, else the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + n for n, b in enumerate(hidden)}


#: The rules, as a tokenizer's file states them, under which a text falls into parts.
NORMALISER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def has_known_rules(model: bytes) -> bool:
    """Whether normaliser, pre-tokenizer, model and added tokens are those that ``parts`` and ``plain_word`` are made for."""
    said = json.loads(model)
    normaliser, pre, bpe = said.get("normalizer") or {}, said.get("pre_tokenizer") or {}, said["model"]
    steps = pre.get("pretokenizers") or [{}, {}]
    return (
        normaliser.get("normalizers") == NORMALISER
        and len(steps) == 2
        and (steps[0].get("type"), steps[0].get("pattern"), steps[0].get("invert")) == ("Split", {"Regex": SPLIT}, True)
        and (steps[1].get("type"), steps[1].get("add_prefix_space"), steps[1].get("use_regex")) == ("ByteLevel", False, False)
        and (bpe.get("type"), bpe.get("dropout"), bpe.get("byte_fallback")) == ("BPE", None, False)
        and all(t["content"].startswith("<|") and not t["normalized"] and not t["lstrip"] and not t["rstrip"] for t in said["added_tokens"])
    )


def splits_into_parts(tokenizer, word: Callable[[str], list[int]]) -> bool:
    """A second look after ``has_known_rules``: texts are tried where a merge over a border would show."""
    probes = ["a b", "a  b\n c\t", " 's t's 1 2", "x ́y", "A B c", "... !!\r\n<", "Σ ΑΣ Σ", "日 本  語 x", "<|endoftext|> a <|startoftext|>b",
              "Don't. it's, X'S.", "12.5, a-b- (C) [9]. _a_", "a\x00. \x1c!", "über-é. Élan, ñandú! 日本語."]
    encode = lambda t: tokenizer.encode(t, add_special_tokens=False).ids

    def by_parts(text: str) -> list[int]:
        out = []
        for chunk in text.encode().split():
            for part in parts(chunk.decode()):
                plain = plain_word(part)
                out += encode(part) if plain is None else word(plain)
        return out

    return all(encode(p) == by_parts(p) for p in probes)


def _groups(texts: pa.Array) -> Iterator[pa.Array]:
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + GROUP_BYTES, side="right")))
        yield texts.slice(at, upto - at)
        at = upto


def encoder(version: str, model: bytes) -> Callable[[pa.Array], Iterator[bytes]]:
    """String array without nulls -> each text's ids as little-endian unsigned 32-bit bytes; kept for the life of the worker."""
    if version in _ENCODERS:
        return _ENCODERS[version]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(model)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenize, letters = tokenizer.model.tokenize, _bytes_as_letters()

    def word(plain: str) -> list[int]:
        return [t.id for t in tokenize(plain if plain.isascii() else plain.encode().decode("latin-1").translate(letters))]

    def part_ids(part: str) -> bytes:
        plain = plain_word(part)
        found = tokenizer.encode(part, add_special_tokens=False).ids if plain is None else word(plain)
        return struct.pack(f"<{len(found)}I", *found)

    memo = Memo(part_ids)

    def chunk_ids(chunk: str) -> bytes:
        head, signs = parts(chunk)
        if head.isascii() and signs != chunk and "<|" not in chunk:
            head = head.lower()
        return memo[head] + memo[signs] if signs else memo[head]

    def by_chunks(texts: pa.Array) -> Iterator[bytes]:
        for group in _groups(texts):
            words = pc.ascii_split_whitespace(group)
            bounds = words.offsets.to_numpy()
            coded = words.values.dictionary_encode()
            if isinstance(coded, pa.ChunkedArray):
                coded = coded.combine_chunks()
            values = list(map(chunk_ids, coded.dictionary.to_pylist()))
            index = coded.indices.to_numpy()
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield b"".join(map(values.__getitem__, index[a:b].tolist()))

    def whole(texts: pa.Array) -> Iterator[bytes]:
        for text in texts:
            yield np.array(tokenizer.encode(text.as_py(), add_special_tokens=False).ids, "<u4").tobytes()

    _ENCODERS[version] = by_chunks if has_known_rules(model) and splits_into_parts(tokenizer, word) else whole
    return _ENCODERS[version]
