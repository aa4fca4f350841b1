"""Histogram and validation tables. Every table is a small aggregate: bin arithmetic, partial sums, one shuffle of bins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jetloom.functions.p4 import col, digitize, logspace, uniform_bin


def _all_bins(df: DataFrame, bins: int, first: int = 0) -> DataFrame:
    return df.sparkSession.range(first, bins + (0 if first == 0 else 1)).select(F.col("id").cast("int").alias("bin"))


def hist_1d(df: DataFrame, x, lo: float, hi: float, bins: int, weight=None, flow: str = "drop", keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, bin, value (count or sum of weights) with every bin of the axis.

    ``flow``: ``drop`` (out of range is dropped, last bin closed), ``bins`` (right-open, under- and
    overflow are bins -1 and ``bins``), ``sum`` (they are added to the edge bins). NaN and NULL are dropped.
    """
    w = F.lit(1.0) if weight is None else col(weight)
    # a generator of one row: x may be a long expression, and the bin's arithmetic names it many times
    rows = df.select(*keys, F.inline(F.array(F.struct(col(x).cast("double").alias("x"), w.alias("w")))))
    rows = rows.where(F.col("x").isNotNull() & ~F.isnan("x"))
    b = uniform_bin("x", lo, hi, bins, last_closed=flow != "bins")
    if flow == "sum":
        b = F.greatest(F.lit(0), F.least(F.lit(bins - 1), b))
    counts = rows.select(*keys, b.alias("bin"), "w").groupBy(*keys, "bin").agg(F.sum("w").cast("double").alias("value"))
    frame = _all_bins(df, bins, -1 if flow == "bins" else 0)
    if keys:
        frame = counts.select(*keys).distinct().join(F.broadcast(frame))  # one row per bin of the axis
    return frame.join(counts, [*keys, "bin"], "left").select(*keys, "bin", F.coalesce("value", F.lit(0.0)).alias("value"))


def hist_edges(df: DataFrame, x, edges: list[float], weight=None, flow: str = "drop", keys: tuple[str, ...] = ()) -> DataFrame:
    """As ``hist_1d`` for bins between any ascending edges; with ``flow`` bins, the last edge belongs to the overflow."""
    w, n = F.lit(1.0) if weight is None else col(weight), len(edges) - 1
    rows = df.select(*keys, F.inline(F.array(F.struct(col(x).cast("double").alias("x"), w.alias("w")))))
    rows = rows.where(F.col("x").isNotNull() & ~F.isnan("x"))
    b = digitize("x", edges) - 1
    if flow != "bins":
        b = F.when(F.col("x") == float(edges[-1]), n - 1).otherwise(b)
    if flow == "sum":
        b = F.greatest(F.lit(0), F.least(F.lit(n - 1), b))
    counts = rows.select(*keys, b.cast("int").alias("bin"), "w").groupBy(*keys, "bin").agg(F.sum("w").cast("double").alias("value"))
    frame = _all_bins(df, n, -1 if flow == "bins" else 0)
    if keys:
        frame = counts.select(*keys).distinct().join(F.broadcast(frame))  # one row per bin of the axis
    return frame.join(counts, [*keys, "bin"], "left").select(*keys, "bin", F.coalesce("value", F.lit(0.0)).alias("value"))


def hist_log(df: DataFrame, x, lo_exponent: float, hi_exponent: float, bins: int, **options) -> DataFrame:
    """``hist_edges`` over a logarithmic axis between two powers of ten."""
    return hist_edges(df, x, logspace(lo_exponent, hi_exponent, bins + 1), **options)


def density(hist: DataFrame, lo: float, hi: float, bins: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """value / (sum * bin width), NULL for an empty histogram."""
    total = F.sum("value").over(Window.partitionBy(*keys))
    return hist.withColumn("value", F.try_divide("value", total * F.lit((hi - lo) / bins)))


def reverse_cumulative(hist: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """bin, value = total minus the sum of bins up to and with this one."""
    upto = F.sum("value").over(Window.partitionBy(*keys).orderBy("bin"))
    return hist.withColumn("value", F.sum("value").over(Window.partitionBy(*keys)) - upto)


def hist_2d(df: DataFrame, x, y, x_axis: tuple[float, float, int], y_axis: tuple[float, float, int], weight=None, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, x_bin, y_bin, value of the bins that have something; axes are (low, high, bins), last bins closed."""
    w = F.lit(1.0) if weight is None else col(weight)
    df = df.select(*keys, F.inline(F.array(F.struct(col(x).alias("__x"), col(y).alias("__y"), w.alias("__w")))))  # as in hist_1d
    bx, by, w = uniform_bin("__x", *x_axis), uniform_bin("__y", *y_axis), F.col("__w")
    rows = df.select(*keys, bx.alias("x_bin"), by.alias("y_bin"), w.alias("w"))
    rows = rows.where(F.col("x_bin").between(0, x_axis[2] - 1) & F.col("y_bin").between(0, y_axis[2] - 1))
    return rows.groupBy(*keys, "x_bin", "y_bin").agg(F.sum("w").alias("value"))


def spread_hist(df: DataFrame, x: str, bins: int, weight: str, range_from: Column, keys: tuple[str, ...]) -> DataFrame:
    """Weighted and plain histograms over ``bins`` equal bins between the least and largest x of the rows of ``range_from``."""
    ends = df.where(range_from).agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    rows = df.join(F.broadcast(ends))  # one row
    b = F.least(F.floor((F.col(x) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    rows = rows.where(F.col(x).between(F.col("lo"), F.col("hi"))).select(*keys, b.cast("int").alias("bin"), weight)
    return rows.groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.sum(weight).alias("sum_w"))


def ratio(hist: DataFrame, key: str, base: str) -> DataFrame:
    """Density ratios of each other group to the ``base`` group; NULL where the base has nothing."""
    total = F.sum("value").over(Window.partitionBy(key))
    d = hist.withColumn("density", F.try_divide("value", total))
    below = d.where(F.col(key) == base).select("bin", F.col("density").alias("base_density"))
    return d.where(F.col(key) != base).join(below, "bin").select(key, "bin", F.try_divide("density", "base_density").alias("ratio"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """value, count, percentage to two places."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("__total"))
    return counts.crossJoin(F.broadcast(total)).select(column, "n", F.round(100.0 * F.col("n") / F.col("__total"), 2).alias("percent"))  # one row


def confusion(df: DataFrame, a: str, b: str) -> DataFrame:
    """a, b, n and the share of equal pairs in all."""
    counts = df.groupBy(a, b).agg(F.count("*").alias("n"))
    same = F.sum(F.when(F.col(a) == F.col(b), F.col("n")).otherwise(0)) / F.sum("n")
    return counts.crossJoin(F.broadcast(counts.agg(same.alias("trace_fraction"))))  # one row


def ordered_confusion(df: DataFrame, a: str, b: str, label: Callable[[Column], Column]) -> DataFrame:
    """The confusion matrix of two lists of codes: a_index, b_index, a_label, b_label, n, and the share of the diagonal in all.

    Rows and columns are in the order of the number of codes, then the codes; the order is over the distinct lists.
    """
    counts = df.groupBy(a, b).agg(F.count("*").alias("n"))
    text = lambda c: F.array_join(F.transform(c, label), ", ")

    def indexed(c: str) -> DataFrame:
        order = Window.orderBy(F.size(c), c)
        return counts.select(c).distinct().select(c, (F.row_number().over(order) - 1).cast("int").alias(f"{c}_index"), text(c).alias(f"{c}_label"))

    placed = counts.join(indexed(a), a).join(indexed(b), b)
    diagonal = F.sum(F.when(F.col(f"{a}_index") == F.col(f"{b}_index"), F.col("n")).otherwise(0)) / F.sum("n")
    out = placed.crossJoin(F.broadcast(placed.agg(diagonal.alias("diagonal"))))  # one row
    return out.select(f"{a}_index", f"{b}_index", f"{a}_label", f"{b}_label", "n", "diagonal")


def validation_tables(jets: DataFrame, keys: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The standard set over jet rows with pt, mass, n_cands, decaymode and long candidate rows' columns."""
    return {
        "jet_pt": hist_1d(jets, "pt", 0.0, 220.0, 50, keys=keys),
        "jet_mass": hist_1d(jets, "mass", 0.0, 10.0, 50, keys=keys),
        "n_cands": hist_1d(jets, "n_cands", 0.0, 50.0, 50, keys=keys),
        "decaymode": hist_1d(jets, "decaymode", 0.0, 16.0, 16, keys=keys),
    }
