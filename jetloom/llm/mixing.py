"""Mixing sources to target weights by a low-discrepancy schedule, all native.

Each source's documents are put in a fixed shuffled order and their words cut into
blocks of equal size. Slots take van der Corput points, mapped through the cumulative
numbers of blocks that the targets ask for to sources; the k-th slot of a source takes the
k-th block of its repeated stream, so a slot's position says when its words come. A source's
slots end at its target, to the word. Of any N points an interval gets its share but for
2/3 log2(N) + 2 (the sequence's discrepancy); no more slots than that may follow the schedule.

A slot's rank is counted from the digits of its source's ends, row by row: an interval from 0
is a few dyadic ones, and in each of these every 2**b-th point falls. Places of documents are made
from sums of buckets in levels. So no window holds a source or the schedule; only the table of
sources itself is ordered in one task.

Defined results: null texts have size 0 and take nothing; the null source is a source of
its own and comes last; null ids are carried through; repeated rows are documents of
their own; an empty table gives an empty result. The shuffle depends on ids, sizes and texts
alone, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written

#: Weights of the sources in order of code points, repeating (fixed values of the contract).
WEIGHTS = (3, 1, 2)
#: The shuffle order is the MD5 of this and the id.
SEED = "mix:"
#: Documents of a bucket, on average; buckets that a window holds; grid cells of the unit interval.
BUCKET_ROWS, FAN, CELLS = 256, 1024, 4096
#: Points of the van der Corput sequence have so many binary digits, and are whole numbers below WHOLE.
DIGITS = 48
WHOLE = 1 << DIGITS


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _source_key(source_col: str) -> Column:
    """A key that is never null: equal for equal sources, and one of its own for the null source."""
    source = F.col(f"`{source_col}`")
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source.cast("string")))


def source_targets(sizes: DataFrame, share: float = 1.5, ceiling: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source_key, n_docs, source_size, target, limit (whole words) from (source, source_key, size).

    The target is the smaller of ceiling * size and level * weight, where the level makes
    all targets share ``share`` of all sizes. With sources in order of ceiling * size / weight,
    the level left for a source and those after it, if all before it are at their ceiling, rises
    as long as that is right and falls afterwards, so the level is the largest of these.
    """
    every = Window.orderBy(F.col("source").isNull(), "source")
    per = sizes.groupBy("source_key").agg(F.first("source").alias("source"), F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(every) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", ceiling * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (share * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    per = per.withColumn("step", level).withColumn("level", F.max("step").over(whole))
    target = F.least("cap", F.col("level") * F.col("weight"))
    return per.select("source_key", "source", "n_docs", "source_size", target.alias("target"), F.floor(target).alias("limit"))


def _sums_before(sums: DataFrame, value: str) -> DataFrame:
    """source_key, bucket, ``before``: the sum of ``value`` over the source's earlier buckets. Windows hold FAN buckets, or groups of FAN."""
    sums = sums.withColumn("upper", F.floor(F.col("bucket") / FAN))
    upper = sums.groupBy("source_key", "upper").agg(F.sum(value).alias("n"))
    earlier = Window.partitionBy("source_key").orderBy("upper").rowsBetween(Window.unboundedPreceding, -1)
    upper = upper.select("source_key", "upper", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    earlier = Window.partitionBy("source_key", "upper").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = sums.withColumn("inside", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
    return inside.join(upper, ["source_key", "upper"]).select("source_key", "bucket", (F.col("first") + F.col("inside")).alias("before"))


def _placed(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Each document with ``at``, the words of its source before it in shuffled order."""
    rows = docs.join(sources.drop("source"), "source_key")
    point = F.conv(F.substring("key", 1, 13), 16, 10).cast("long")
    buckets = F.ceil(F.col("n_docs") / BUCKET_ROWS)
    rows = rows.withColumn("bucket", F.floor(point / F.lit(float(1 << 52)) * buckets))
    sums = _sums_before(rows.groupBy("source_key", "bucket").agg(F.sum("size").alias("bucket_size")), "bucket_size")
    within = Window.partitionBy("source_key", "bucket").orderBy("key", "id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return inside.join(sums, ["source_key", "bucket"]).withColumn("at", F.col("before") + F.col("inside")).drop("inside", "before", "bucket")


def radical_inverse(k: Column) -> Column:
    """The van der Corput point of k, times WHOLE: its digits in reverse."""
    return F.conv(F.reverse(F.lpad(F.bin(k), DIGITS, "0")), 2, 10).cast("long")


def _steps(x: Column) -> Column:
    """The dyadic intervals that make up [0, x): of b binary digits each, reached by every 2**b-th point from a first one on."""
    bits = F.lpad(F.bin(x), DIGITS + 1, "0")  # x may be WHOLE itself
    ones = F.filter(F.sequence(F.lit(0), F.lit(DIGITS)), lambda b: F.substr(bits, b + 1, F.lit(1)) == "1")

    def step(b: Column) -> Column:
        digits = F.concat(F.lit("0"), F.reverse(F.concat(F.substr(bits, F.lit(2), b - 1), F.lit("0"))))
        first = F.when(b == 0, 0).otherwise(F.conv(digits, 2, 10).cast("long"))
        return F.struct(F.pow(F.lit(2.0), b).cast("long").alias("every"), first.cast("long").alias("first"))

    return F.transform(ones, step)


def _counted(n: Column, steps: Column) -> Column:
    """How many of the first n points are in the intervals of ``steps``."""
    return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + F.floor((n + x.every - 1 - x.first) / x.every))


def schedule(sources: DataFrame, block_words: int) -> DataFrame:
    """source_key, position, rank, block, words: the mix in order of ``position``."""
    spark = sources.sparkSession
    live = sources.where("limit > 0")
    block_words_ = F.lit(block_words)
    blocks = F.ceil(F.col("source_size") / block_words_)
    passes = F.floor(F.col("limit") / F.col("source_size"))
    over = F.col("limit") - passes * F.col("source_size")
    live = live.withColumn("blocks", blocks).withColumn("passes", passes).withColumn("over", over)
    live = live.withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("over") / block_words_))
    total = live.agg(F.sum("slots")).first()[0] or 0

    upto = F.sum("slots").over(Window.orderBy("source_key"))
    end = lambda slots: F.floor(slots / F.lit(float(total or 1)) * float(WHOLE))
    live = live.withColumns({"lo": end(upto - F.col("slots")), "hi": end(upto)})
    live = live.withColumns({"below_lo": _steps(F.col("lo")), "below_hi": _steps(F.col("hi"))})
    cell = lambda x: F.floor(x / F.lit(WHOLE // CELLS))
    cells = live.where("lo < hi").withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))))

    points = spark.range(total).select(F.col("id").alias("position"), radical_inverse(F.col("id")).alias("u")).withColumn("cell", cell(F.col("u")))
    drawn = points.join(cells, "cell").where("u >= lo and u < hi")
    rank = lambda n: _counted(n, F.col("below_hi")) - _counted(n, F.col("below_lo"))
    columns = ["source_key", "source_size", "blocks", "passes", "over", "position", "rank"]
    ranked = drawn.withColumn("rank", rank(F.col("position"))).where("rank < slots").select(*columns)

    have = live.withColumn("have", rank(F.lit(total))).where("have < slots")
    most = math.ceil(math.log2(total + 1) * 2 / 3) + 2
    last = F.least(F.col("slots"), F.col("have") + most) - 1
    tail = have.withColumn("rank", F.explode(F.sequence("have", last))).withColumn("position", F.lit(total) + F.col("rank")).select(*columns)

    slots = ranked.unionByName(tail)
    whole = F.floor(F.col("rank") / F.col("blocks")) < F.col("passes")
    block = F.col("rank") % F.col("blocks")
    part = F.least(block_words_, F.when(whole, F.col("source_size")).otherwise(F.col("over")) - block * block_words)
    return slots.select("source_key", "position", "rank", block.alias("block"), part.cast("long").alias("words"))


def _sized(docs: DataFrame, id_col: str, source_col: str, text: str) -> DataFrame:
    """``docs`` as a struct ``row``, with id, source, source_key, size, key (the shuffle's) and tie (of rows alike in all these)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    ident, body = F.col(f"`{id_col}`"), text_or_empty(f"`{text}`")
    return docs.select(
        row,
        ident.alias("id"),
        F.col(f"`{source_col}`").alias("source"),
        _source_key(source_col).alias("source_key"),
        word_count(body).alias("size"),
        F.md5(F.concat(F.lit(SEED), F.coalesce(ident.cast("string"), F.lit("")))).alias("key"),
        F.xxhash64(body).alias("tie"),
        F.monotonically_increasing_id().alias("at_row"),
    )


def _taken(base: DataFrame, share: float, ceiling: float, weights: tuple[int, ...], block_words: int) -> DataFrame:
    """at_row, id, size, source_size, target, at, taken, first_position, starts of every row of ``base`` (written).

    first_position: of the first slot that takes words of the document. starts: positions of the
    slots that take its beginning, in the order of the source's passes.
    """
    sources = written(source_targets(base, share, ceiling, weights), "mix-sources", few_files=True)
    placed = _placed(base.drop("source"), sources)
    block = lambda word: F.floor(word / block_words)
    pieces = placed.where("size > 0").withColumn("block", F.explode(F.sequence(block(F.col("at")), block(F.col("at") + F.col("size") - 1))))
    start = F.col("block") * block_words
    pieces = pieces.withColumn("lo", F.greatest(F.col("at"), start) - start)
    pieces = pieces.withColumn("hi", F.least(F.col("at") + F.col("size"), start + block_words) - start)
    slots = schedule(sources, block_words).select("source_key", "block", "rank", "position", "words")
    met = pieces.join(slots, ["source_key", "block"], "left")
    words = F.greatest(F.lit(0), F.least("hi", "words") - F.col("lo"))
    begins = F.when((words > 0) & (F.col("block") == block(F.col("at"))), F.struct("rank", "position"))
    row = ["at_row", "id", "size", "source_size", "target", "at"]
    taken = met.groupBy(*row).agg(
        F.coalesce(F.sum(F.when(F.col("words").isNotNull(), words)), F.lit(0)).alias("taken"),
        F.min(F.when(words > 0, F.col("position"))).alias("first_position"),
        F.transform(F.array_sort(F.collect_list(begins)), lambda x: x.position).alias("starts"),
    )
    none = {"taken": F.lit(0).cast("long"), "first_position": F.lit(None).cast("long"), "starts": F.array().cast("array<bigint>")}
    return taken.unionByName(placed.where("size = 0").select(*row).withColumns(none))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text: str = "text",
    share: float = 1.5,
    ceiling: float = 2.0,
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int = 1024,
) -> DataFrame:
    """id, size, source_size, target, taken, first_position (in the mix, NULL if nothing is taken) of every document."""
    base = written(_sized(docs, id_col, source_col, text).drop("row"), "mix-sizes")
    out = _taken(base, share, ceiling, weights, block_words)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", "first_position")


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text: str = "text",
    share: float = 1.5,
    ceiling: float = 2.0,
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int = 1024,
    ordered: bool = True,
) -> DataFrame:
    """The mix itself in the schedule's order, with the columns that came in; without ``ordered`` the same rows in any order.

    There is a row for each whole time a document is taken, and one with its first words for a rest; each
    stands where the slot stands that takes its beginning.
    """
    rows = written(_sized(docs, id_col, source_col, text), "mix-rows")
    times = _taken(rows.drop("row"), share, ceiling, weights, block_words).where("taken > 0")
    times = times.select("at_row", "at", "taken", F.posexplode(F.slice("starts", 1, F.ceil(F.col("taken") / F.col("size")).cast("int"))).alias("time", "position"))
    out = rows.select("row", "at_row", "size").join(times, "at_row")
    words = F.least(F.col("size"), F.col("taken") - F.col("time") * F.col("size"))
    # the shortest beginning of the text with that many words: words with the white space before each
    body = F.col("row")[text]
    spaced = F.regexp_extract_all(body, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    head = F.array_join(F.slice(spaced, 1, words.cast("int")), "")
    cut = F.when(words < F.col("size"), head).otherwise(body)
    columns = [cut.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    return (out.orderBy("position", "at", "time") if ordered else out).select(*columns)
