"""The validation tables by name, with their usual axes. Drawing them is not this engine's part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jetloom.functions import p4, pdg
from jetloom.functions.p4 import col, uniform_bin

from .histograms import _all_bins, density, hist_1d, hist_2d, value_shares

# Fixed values: (low, high, bins) of the usual axes.
JET_PT, N_CANDS, SHAPE, LIFETIME = (0.0, 220.0, 50), (0.0, 50.0, 50), (-0.05, 0.05, 69), (0.0, 5.0, 99)
MODES, WEIGHT, PT_RATIO, LOG_SIGMA = (0.0, 16.0, 16), (0.0, 1.0, 50), (0.75, 1.25, 100), (-4.0, 0.0, 79)

#: Names of the grouped modes, by ``pdg.plot_mode``.
MODE_LABELS = {0: "h", 1: "h pi0", 2: "h 2+pi0", 3: "3h", 4: "3h 1+pi0", 5: "other"}


def jet_pt(jets: DataFrame, pt="pt", mode: int | None = None, decaymode="decaymode", keys: tuple[str, ...] = ()) -> DataFrame:
    rows = jets if mode is None else jets.where(col(decaymode) == mode)
    return density(hist_1d(rows, pt, *JET_PT, flow="sum", keys=keys), *JET_PT, keys=keys)


def constituents(jets: DataFrame, n="n_cands", keys: tuple[str, ...] = ()) -> DataFrame:
    return hist_1d(jets, col(n).cast("double"), *N_CANDS, keys=keys)


def decay_modes(jets: DataFrame, decaymode="decaymode", keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts by mode (15 and 16 share the last bin, -1 is out) with percentages."""
    h = hist_1d(jets, col(decaymode).cast("double"), *MODES, keys=keys)
    return h.withColumn("percent", F.round(F.try_divide(100.0 * F.col("value"), F.sum("value").over(Window.partitionBy(*keys))), 2))


def mode_shares(jets: DataFrame, decaymode: str = "decaymode") -> DataFrame:
    return value_shares(jets, decaymode)


def jet_shape(rows: DataFrame, by_mode: bool = False, axis=SHAPE) -> DataFrame:
    """Sum of pt over the number of jets, in (eta, phi) of jet minus candidate; ``by_mode``: for each grouped mode 0-4.

    Needs event_id, jet_id, pt, eta, phi, jet_eta, jet_phi and, by mode, decaymode.
    """
    rows = rows.withColumns({"d_eta": F.col("jet_eta") - F.col("eta"), "d_phi": p4.signed_delta_phi("jet_phi", "phi")})
    keys: tuple[str, ...] = ()
    if by_mode:
        rows, keys = rows.withColumn("mode", pdg.plot_mode("decaymode")).where("mode between 0 and 4"), ("mode",)
    jets = rows.groupBy(*keys).agg(F.count_distinct("event_id", "jet_id").alias("n_jets"))
    h = hist_2d(rows, "d_eta", "d_phi", axis, axis, "pt", keys)
    both = h.join(F.broadcast(jets), list(keys)) if keys else h.crossJoin(F.broadcast(jets))  # one row a mode
    return both.withColumn("value", F.col("value") / F.col("n_jets")).drop("n_jets")


def lifetime_variable(rows: DataFrame, x, axis=LIFETIME, keys: tuple[str, ...] = ()) -> DataFrame:
    """Absolute values of the candidates that have a track."""
    rows = rows.select(*keys, F.inline(F.array(F.struct(col(x).alias("x"))))).where("x > -999")  # as in log_sigma
    return hist_1d(rows, F.abs("x"), *axis, keys=keys)


def log_sigma(rows: DataFrame, sigma, axis=LOG_SIGMA) -> DataFrame:
    """Density over the logarithm of an error; errors that are not positive are left out."""
    # a generator of one row: the error may be a long expression, which a filter and the axis would name many times
    rows = rows.select(F.inline(F.array(F.struct(col(sigma).alias("sigma"))))).where("sigma > 0")
    return density(hist_1d(rows, F.log10("sigma"), *axis), *axis)


def energy_map(rows: DataFrame, gen, reco, bins: int = 50) -> DataFrame:
    """Counts over (generated, reconstructed) energy, both axes from 0 to the largest of either."""
    top = rows.agg(F.greatest(F.max(col(gen)), F.max(col(reco))).alias("top"))
    scaled = rows.crossJoin(F.broadcast(top))  # one row
    return hist_2d(scaled.select((col(gen) / F.col("top")).alias("g"), (col(reco) / F.col("top")).alias("r")), "g", "r", (0.0, 1.0, bins), (0.0, 1.0, bins))


def weight_distribution(jets: DataFrame, weight: str = "cls_weight", keys: tuple[str, ...] = ()) -> DataFrame:
    h = hist_1d(jets, weight, *WEIGHT, keys=keys)
    return h.withColumn("value", F.try_divide("value", F.sum("value").over(Window.partitionBy(*keys))))


def pt_ratio(pairs: DataFrame, reco="reco_pt", gen="gen_pt") -> DataFrame:
    """Share of pairs by reconstructed over generated pt; pairs out of range count in the total."""
    placed = pairs.select(F.inline(F.array(F.struct(F.try_divide(col(reco), col(gen)).alias("x"))))).select(uniform_bin("x", *PT_RATIO).alias("bin"))
    counts = placed.groupBy("bin").agg(F.count("*").alias("n"))  # of every bin and what is beyond, so that the pairs are made once
    both = _all_bins(pairs, PT_RATIO[2]).join(F.broadcast(counts), "bin", "left").crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total"))))  # one row
    return both.select("bin", F.try_divide(F.coalesce("n", F.lit(0)).cast("double"), F.col("total")).alias("value"))


def pooled_log_ratio(df: DataFrame, x: str, key: str, base: str, bins: int = 50) -> DataFrame:
    """Density ratios to the ``base`` group in logarithmic bins from the least to the largest positive value of all groups."""
    rows = df.where(F.col(x) > 0).select(key, F.log10(x).alias("lx"))
    ends = rows.agg(F.min("lx").alias("lo"), F.max("lx").alias("hi"))
    placed = rows.crossJoin(F.broadcast(ends))  # one row
    b = F.least(F.floor(F.try_divide(F.col("lx") - F.col("lo"), F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    counts = placed.select(key, b.alias("bin")).groupBy(key, "bin").agg(F.count("*").alias("n"))
    share = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(key)))
    below = share.where(F.col(key) == base).select("bin", F.col("share").alias("base_share"))
    return share.where(F.col(key) != base).join(below, "bin", "left").select(key, "bin", F.try_divide("share", "base_share").alias("ratio"))


#: Published branching fractions of the tau in per cent, with their errors, by decay mode.
PUBLISHED = {0: (10.82, 0.05), 1: (25.49, 0.09), 2: (9.26, 0.10), 10: (8.99, 0.05), 11: (2.74, 0.07), 16: (35.21, 0.06)}


def against_published(rows: DataFrame, decaymode: str = "decaymode", base: int = 0, published: dict = PUBLISHED) -> DataFrame:
    """decaymode, ratio to the ``base`` mode's count with its statistical error, and the published fractions' ratio."""
    table = rows.sparkSession.createDataFrame([(k, v / published[base][0]) for k, (v, _) in published.items()], f"{decaymode} int, published double")
    counts = rows.groupBy(decaymode).agg(F.count("*").alias("n"))
    both = counts.join(F.broadcast(table), decaymode)  # a row for each published mode
    all_base = both.agg(F.max(F.when(F.col(decaymode) == base, F.col("n"))).alias("n0"))
    ratio = F.try_divide("n", "n0")
    out = both.crossJoin(F.broadcast(all_base))  # one row
    return out.select(decaymode, ratio.alias("ratio"), (ratio * F.sqrt(F.try_divide(F.lit(1), "n") + F.try_divide(F.lit(1), "n0"))).alias("error"), "published")


def species_of(rows: DataFrame, codes: dict[str, tuple[int, ...]]) -> Column:
    """The species' name of each candidate, NULL for others."""
    out = F.lit(None).cast("string")
    for name, own in codes.items():
        out = F.when(F.abs("pdg").isin(*own), name).otherwise(out)
    return out
