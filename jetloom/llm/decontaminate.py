"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. The items' word
sequences go into one suffix automaton, which reads a text's words from left to right and holds
the longest run of words, ending at the present one, that stands in some item. A run of
``window`` words or more is a span of the test set; an item of fewer words counts where the whole of it stands.
Items that a run belongs to are those of the automaton's state at ``window`` words.

A text needs the automaton only where every gram of ``GRAM`` words (or, for shorter items, the item) is one of
the items': word numbers and grams of a text are looked up in arrays first, and the automaton reads the stretches that are left.
Outside of them no run can reach its length, so results are those of reading everything.

The items are cut into shards of at most ``SHARD_WORDS`` words (a longer item with an overlap of a
window), and one automaton is built a shard, in a task. An automaton of a full shard is bounded by that
number, is the only thing that is broadcast, and the documents are read once for each shard.

Defined results: a null text has no words, as item or document; rows with the same item_id are one item; items with a null id
count as one without a name; repeated rows of documents stay; an item without words is found nowhere; without items nothing is found;
an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import sliced, written

WINDOW = 10
GRAM = 4
#: Words of the items in one automaton. It has two states a word at most, of some 400 bytes in memory: 160 MB; 20 MB are broadcast.
SHARD_WORDS = 200_000

#: Bytes that are no word's are turned into spaces, A-Z into a-z.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


@dataclass
class Automaton:
    """Generalised suffix automaton over word numbers; state 0 is the root."""

    window: int = WINDOW
    numbers: dict[bytes, int] = field(default_factory=dict)
    names: list = field(default_factory=list)
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    #: items of the windows that a state stands for, at the state whose runs include those of ``window`` words
    items: dict[int, set[int]] = field(default_factory=dict)
    #: state -> (words, item) of short items that end there
    short: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    known: dict[int, int] = field(default_factory=dict)
    grams: dict[int, np.ndarray] = field(default_factory=dict)

    def _extend(self, last: int, word: int) -> int:
        """The state of the text so far and ``word``; an existing one is used again, split if it stands for longer runs too."""
        nxt, link, size = self.next, self.link, self.size
        if word in nxt[last]:
            q = nxt[last][word]
            return q if size[q] == size[last] + 1 else self._split(last, q, word)
        new = self._state(size[last] + 1, {}, 0)
        p = last
        while p != -1 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p != -1:
            q = nxt[p][word]
            link[new] = q if size[q] == size[p] + 1 else self._split(p, q, word)
        return new

    def _state(self, size: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """The part of state ``q`` whose runs are those of ``p`` and ``word``."""
        nxt, link = self.next, self.link
        part = self._state(self.size[p] + 1, dict(nxt[q]), link[q])
        link[q] = part
        while p != -1 and nxt[p].get(word) == q:
            nxt[p][word] = part
            p = link[p]
        return part

    def at_window(self, state: int) -> int:
        """The state of the last ``window`` words of the runs that ``state`` stands for."""
        at, passed = state, []
        while at not in self.known and self.size[self.link[at]] >= self.window:
            passed.append(at)
            at = self.link[at]
        at = self.known.get(at, at)
        self.known.update(dict.fromkeys(passed, at))
        return at

    def build(self, items: list[tuple[object, list[bytes]]]) -> Automaton:
        texts = []
        for name, words in items:
            texts.append((name, [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]))
            last = 0
            for w in texts[-1][1]:
                last = self._extend(last, w)
        number: dict[object, int] = {}
        for name, words in texts:
            item = number.setdefault(name, len(number))
            state = n = 0
            for w in words:  # states are final now
                state, n = self.next[state][w], n + 1
                if n >= self.window:
                    self.items.setdefault(self.at_window(state), set()).add(item)
            if 0 < len(words) < self.window:
                self.short.setdefault(state, []).append((n, item))
        self.names = list(number)
        for n in range(1, min(GRAM, self.window) + 1):
            own = [_mixed(np.array(w, np.int64), n) for _, w in texts if n == min(GRAM, self.window, len(w))]
            if own:
                self.grams[n] = np.unique(np.concatenate(own))
        return self

    @cached_property
    def maps(self) -> dict[int, tuple[np.ndarray, int]]:
        """Maps of the grams that a run has to consist of: ``GRAM`` words, or all of a shorter item's; and the bits of a place."""
        made = {}
        for n, grams in self.grams.items():
            bits = max(16, (32 * len(grams)).bit_length())
            places = np.zeros(1 << bits, bool)
            places[grams >> np.uint64(64 - bits)] = True
            made[n] = places, bits
        return made

    def stretches(self, words: np.ndarray) -> list[tuple[int, int]]:
        """First and last-and-one places of words where runs of sufficient length can stand."""
        covered = np.zeros(len(words) + 1, np.int32)
        for n, (places, bits) in self.maps.items():
            if len(words) >= n:
                found = np.flatnonzero(places[_mixed(words, n) >> np.uint64(64 - bits)])
                np.add.at(covered, found, 1)
                np.add.at(covered, found + n, -1)
        inside = np.concatenate([[0], np.cumsum(covered[:-1]) > 0, [0]])
        edges = np.flatnonzero(np.diff(inside))
        return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))

    def read(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest run at each word."""
        nxt, link, size = self.next, self.link, self.size
        state = n = 0
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                n = size[state]
            if w in nxt[state]:
                state, n = nxt[state][w], n + 1
            yield state, n

    def found(self, words: list[bytes]) -> tuple[list[list[int]], set[int]]:
        """Spans [first, last and one) of words of the test set, apart and in order, and the items that stand in the text."""
        numbers = np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words))
        spans: list[list[int]] = []
        items: set[int] = set()
        windows: set[int] = set()
        for lo, hi in self.stretches(numbers):
            for at, (state, n) in enumerate(self.read(numbers[lo:hi].tolist()), lo + 1):
                longest = 0
                if n >= self.window:
                    longest = n
                    windows.add(self.at_window(state))
                while state and self.short:
                    for m, item in self.short.get(state, ()):
                        if m <= n:
                            longest = max(longest, m)
                            items.add(item)
                    state = self.link[state]
                if longest:
                    first = at - longest
                    while spans and spans[-1][0] >= first:
                        spans.pop()
                    if spans and spans[-1][1] >= first:
                        spans[-1][1] = at
                    else:
                        spans.append([first, at])
        return spans, items.union(*(self.items[w] for w in windows))


class Packed:
    """An automaton on its way to the tasks; each worker unpacks it once."""

    def __init__(self, body: bytes) -> None:
        self.body = body

    @cached_property
    def automaton(self) -> Automaton:
        return pickle.loads(self.body)


def _mixed(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words, to be used by its upper bits."""
    with np.errstate(over="ignore"):
        h = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for i in range(n):
            h = (h ^ words[i : i + len(h)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h


def _automata(items: DataFrame, id_col: str, text: str, window: int, shard_words: int) -> DataFrame:
    """shard, automaton (pickled): built in tasks, each of ``shard_words`` words at most."""
    kind = items.schema[id_col].dataType
    piece = T.StructType([T.StructField("name", kind), T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("n", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, shard_words - window)
        for batch in sliced(batches, 64):
            names, words = [], []
            for name, body in zip(batch.column("name").to_pylist(), batch.column("body").cast(pa.binary()).to_pylist(), strict=True):
                w = words_of(body)
                for at in range(0, max(1, len(w) - window + 1), step):
                    if w:
                        names.append(name)
                        words.append(w[at : at + step + window - 1])
            yield pa.RecordBatch.from_arrays([pa.array(names, batch.schema.field("name").type), pa.array(words, pa.list_(pa.binary())), pa.array([len(w) for w in words], pa.int64())], ["name", "words", "n"])

    pieces = written(items.select(F.col(id_col).alias("name"), F.col(text).alias("body")).mapInArrow(cut, piece), "decontaminate-items")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    shards = -(-2 * total // shard_words)  # half full on average, by hash

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[object, list[bytes]]] = []
        n, at = 0, None
        for batch in batches:
            for name, words, deal in zip(*(batch.column(c).to_pylist() for c in ("name", "words", "deal")), strict=True):
                if held and (deal != at or n + len(words) > shard_words):  # the bound holds whatever the hash does
                    yield packed(held)
                    held, n = [], 0
                at = deal
                held.append((name, words))
                n += len(words)
        if held:
            yield packed(held)

    def packed(held: list[tuple[object, list[bytes]]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Automaton(window).build(held), 5)], pa.binary())], ["automaton"])

    dealt = pieces.withColumn("deal", F.pmod(F.xxhash64("name", "words"), F.lit(max(1, shards))))
    dealt = dealt.repartition(max(1, shards), "deal").sortWithinPartitions("deal")
    return written(dealt.mapInArrow(build, "automaton binary").withColumn("shard", F.monotonically_increasing_id()), "decontaminate-automata")


def spans(
    docs: DataFrame, items: DataFrame, id_col: str = "item_id", text: str = "text", item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """row (the columns that came in), n_words, spans (array of first, last-and-one word, apart and in order), item_ids (array), n_items."""
    spark = docs.sparkSession
    kind = items.schema[id_col].dataType
    span = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
    rows = docs.select(F.struct("*").alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("spans", span), T.StructField("item_ids", T.ArrayType(kind))])
    made = _automata(items, id_col, item_text, window, shard_words)
    shards = [r.shard for r in made.select("shard").orderBy("shard").collect()]
    found = rows
    for k, shard in enumerate(shards or [None]):
        packed = None if shard is None else spark.sparkContext.broadcast(Packed(made.where(F.col("shard") == shard).first().automaton))
        found = _scanned(found, packed, text, schema, k > 0)
        if len(shards) > 1:
            found = written(found, "decontaminate-spans")  # a task holds one automaton at a time
    return found.withColumn("n_items", F.size("item_ids").cast("long"))


def _scanned(rows: DataFrame, packed: Broadcast | None, text: str, schema: T.StructType, more: bool) -> DataFrame:
    """Spans and items of one automaton, added to those found before."""
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = packed.value.automaton if packed else Automaton()
        for batch in sliced(batches, 256):
            bodies = batch.column("row").field(text).cast(pa.binary()).to_pylist()
            had = [batch.column(c).to_pylist() if more else [[]] * len(bodies) for c in ("spans", "item_ids")]
            n_words, spans, items = [], [], []
            for body, spans_had, items_had in zip(bodies, *had, strict=True):
                words = words_of(body)
                n_words.append(len(words))
                found, named = automaton.found(words)
                spans.append(joined([(x["first"], x["end"]) for x in spans_had] + [tuple(x) for x in found]))
                items.append(list(dict.fromkeys([*items_had, *(automaton.names[i] for i in named)])))
            columns = [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(spans, out.field("spans").type), pa.array(items, out.field("item_ids").type)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "spans", "item_ids"])

    return rows.mapInArrow(run, schema)


def joined(spans: list[tuple[int, int]]) -> list[dict]:
    """Spans that touch or overlap as one."""
    out: list[dict] = []
    for first, end in sorted(spans):
        if out and first <= out[-1]["end"]:
            out[-1]["end"] = max(end, out[-1]["end"])
        else:
            out.append({"first": first, "end": end})
    return out


def _n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])


def report(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", **options) -> DataFrame:
    """The contract's columns of every document."""
    names = F.array_sort(F.transform(F.filter("item_ids", lambda i: i.isNotNull()), lambda i: i.cast("string")))
    return spans(docs, items, item_id, **options).select(
        F.col("row")[doc_id].alias(doc_id), "n_words", _n_hit().alias("n_hit"), "n_items",
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", max_words: int = 0, max_coverage: float = 1.0, **options) -> DataFrame:
    """The documents with their columns, without the spans of the test set.

    Spans of more than ``max_words`` words are cut out, from the first word's beginning to the last one's end;
    documents of which more than ``max_coverage`` of the words are hit go. Others stay as they are.
    """
    found = spans(docs, items, text=text, **options).where(_n_hit() <= max_coverage * F.greatest("n_words", F.lit(1)))
    schema = T.StructType([found.schema["row"], T.StructField("kept_text", docs.schema[text].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 256):
            texts = []
            bodies = batch.column("row").field(text).cast(pa.binary()).to_pylist()
            for body, cut in zip(bodies, batch.column("spans").to_pylist(), strict=True):
                cut = [s for s in cut if s["end"] - s["first"] > max_words]
                texts.append(without(body, cut) if cut else body)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.binary()).cast(pa.string())], ["row", "kept_text"])

    kept = found.select("row", "spans").mapInArrow(run, schema)
    return kept.select(*[F.col("kept_text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


def without(body: bytes, spans: list[dict]) -> bytes:
    """The text without these spans of words."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", body.translate(_TABLE))]
    out, at = [], 0
    for s in spans:
        out.append(body[at : places[s["first"]][0]])
        at = places[s["end"] - 1][1]
    return b"".join([*out, body[at:]])
