"""Edge tables of the pure functions."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from jetloom.functions import arrays, p4, pdg
from jetloom.operators import filters, histograms, lifetime, matching, sampling, taus, weights


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("ids", "mode"),
    [([211], 0), ([211, 130], 1), ([-211, 130, 130], 2), ([211] + [130] * 3, 3), ([211] + [130] * 6, 4), ([211, 211], 5), ([211, 211, 130], 6),
     ([211] * 2 + [130] * 2, 7), ([211] * 2 + [130] * 3, 8), ([211] * 2 + [130] * 5, 9), ([211] * 3, 10), ([211] * 3 + [130], 11), ([211] * 3 + [130] * 2, 12),
     ([211] * 3 + [130] * 3, 13), ([211] * 3 + [130] * 4, 14), ([211, 22], 15), ([211] * 4, 15), ([], 15), ([16], 15), ([11, 12, 16], 16), ([13], 16), ([11, 211], 0)],
)
def test_decay_modes(spark, ids, mode):
    assert one(spark, pdg.decay_mode_of(F.array(*[F.lit(i) for i in ids]).cast("array<int>"))) == mode


def test_mode_reductions(spark):
    modes = [-1, *range(17)]
    df = spark.createDataFrame([(m,) for m in modes], "m int")
    rows = df.select("m", pdg.reduced_mode("m").alias("r"), pdg.plot_mode("m").alias("p"), pdg.mode_name("m").alias("n")).collect()
    by = {x.m: x for x in rows}
    assert [by[m].r for m in modes] == [15, 0, 1, 2, 2, 2, 10, 11, 11, 11, 11, 10, 11, 11, 11, 11, 15, 16]
    assert [by[m].p for m in modes] == [-1, 0, 1, 2, 2, 2, 5, 5, 5, 5, 5, 3, 4, 4, 4, 4, 5, -1]
    assert by[4].n == "OneProngNPiZero" and by[11].n == "ThreeProng1PiZero" and by[16].n == "LeptonicDecay" and by[-1].n is None


def test_unknown_codes_have_no_charge(spark):
    assert one(spark, pdg.table_charge(F.lit(-211))) == -1 and one(spark, pdg.table_charge(F.lit(15))) == -1 and one(spark, pdg.table_charge(F.lit(99999))) is None


def test_four_vectors(spark):
    v = one(spark, p4.from_cartesian(F.lit(3.0), F.lit(4.0), F.lit(0.0), m=F.lit(0.0)))
    assert (v.pt, v.eta, v.energy) == (5.0, 0.0, 5.0) and v.phi == pytest.approx(math.atan2(4, 3))
    z = one(spark, p4.from_cartesian(F.lit(0.0), F.lit(0.0), F.lit(2.0), m=F.lit(0.0)))
    assert z.eta == math.inf and one(spark, p4.from_cartesian(F.lit(0.0), F.lit(0.0), F.lit(0.0), m=F.lit(1.0))).eta == 0.0
    assert one(spark, p4.np_div(F.lit(1.0), F.lit(0.0))) == math.inf and math.isnan(one(spark, p4.np_div(F.lit(0.0), F.lit(0.0))))
    assert one(spark, p4.delta_phi(F.lit(3.1), F.lit(-3.1))) == pytest.approx(2 * math.pi - 6.2)
    assert not one(spark, p4.finite(F.lit(float("nan")))) and one(spark, p4.nan_to_zero(F.lit(float("nan")))) == 0.0


def test_bins_agree_with_numpy(spark):
    edges = np.linspace(2, 55, 53)
    xs = [2.0, 1.999, 55.0, 55.001, float(edges[1]), float(edges[30]), float(np.nextafter(edges[7], 0)), 20.3, float("nan")]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(p4.uniform_bin("x", 2.0, 55.0, 52)).collect()]
    for x, b in zip(xs, got, strict=True):
        counts, _ = np.histogram([x] if not math.isnan(x) else [], edges)
        assert (b if 0 <= b < 52 else None) == (int(counts.argmax()) if counts.any() else None)
    centres = (edges[1:] + edges[:-1]) / 2
    xs = [x for x in xs if not math.isnan(x)] + [float(np.nextafter(centres[5], 0)), float(np.nextafter(centres[5], 99)), -5.0, 99.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(weights.centre_bin("x", (2.0, 55.0, 53))).collect()]
    assert got == [int(np.clip(np.digitize(x, centres) - 1, 0, 51)) for x in xs]
    assert one(spark, p4.digitize(F.lit(0.5), [0.0, 0.5, 1.0])) == 2


def test_weight_matrix_zeros(spark):
    t = spark.createDataFrame([(0, 0, 0.5), (1, 0, 0.5)], "theta_bin int, p_bin int, fraction double")
    o = spark.createDataFrame([(0, 0, 0.25), (5, 5, 0.75)], "theta_bin int, p_bin int, fraction double")
    assert {r.theta_bin: r.weight for r in weights.weight_matrix(t, o).collect()} == {0: 0.5, 1: 0.0}


def test_track_through_the_vertex_and_sentinel(spark):
    rows = [(1, 0.0, 0.0, 0.3, 0.5, 0.0, 0.0, 0.0), (2, None, 0.0, 0.3, 0.5, 0.0, 0.0, 0.0), (3, 0.01, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (5, 0.01, 0.0, 0.0, 0.0, 0.2, 0.3, 0.0)]
    p = spark.createDataFrame([(r[0], 0, *r[1:5]) for r in rows], "event_id long, pidx int, d0 double, z0 double, phi0 double, tanl double")
    p = p.withColumns({c: F.lit(1e-6) for c in ("c_d0", "c_phi", "c_z0", "c_tan")} | {"omega": F.lit(0.1), "zr": F.lit(0.0)})
    p = p.withColumns({"xr": F.when(F.col("event_id") == 5, 0.2).otherwise(0.0), "yr": F.when(F.col("event_id") == 5, 0.31).otherwise(0.0)})
    v = spark.createDataFrame([(r[0], *r[5:8]) for r in rows], "event_id long, pvx double, pvy double, pvz double")
    out = {r.event_id: r for r in lifetime.lifetime(p, v).collect()}
    assert out[1].dxy == out[1].d3 == 0.0 and out[1].dxy_error == out[1].d3_error == 0.0 and out[1].dz_error > 0
    assert {out[2][c] for c in lifetime.VARIABLES.values()} == {lifetime.SENTINEL}  # no track
    assert out[5].dxy == pytest.approx(0.0, abs=1e-12) and (out[5].pca_x, out[5].pca_y) == pytest.approx((0.2, 0.3))  # the reference point moves the track
    assert out[3].dxy == pytest.approx(0.01) and out[3].pca_y == pytest.approx(-0.01)
    s = lambda ip, q: one(spark, lifetime.signed(F.lit(ip), *map(F.lit, q), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0), F.lit(0.0)))
    assert s(0.5, (-1.0, 0.0, 0.0)) == -0.5 and s(-0.5, (1.0, 0.0, 0.0)) == 0.5 and s(0.5, (0.0, 0.0, 0.0)) == 0.5 and s(-1000.0, (-1.0, 0.0, 0.0)) == -1000.0


def test_matching_ties_zero_energy_and_empty_sides(spark):
    kind = "event_id long, pidx int, eta double, phi double, energy double"
    left = spark.createDataFrame([(1, 0, 0.0, 0.0, 1.0), (1, 1, 0.1, 0.0, 1.0), (1, 2, 0.0, 0.0, 0.0), (2, 0, 0.0, 0.0, 1.0)], kind)
    right = spark.createDataFrame([(1, 5, 0.05, 0.0, 1.0), (1, 6, 0.05, 0.0, 1.0), (1, 7, 0.4, 0.0, 1.0), (1, 8, 0.0, 0.0, 0.0)], kind)
    got = {(r.event_id, r.left_id): r.right_id for r in matching.nearest(left, right, energy="energy").collect()}
    assert got == {(1, 0): 5, (1, 1): 5}
    far = matching.nearest(left.where("pidx = 0"), right.where("pidx = 7"), 0.4)
    assert far.count() == 0 and matching.nearest(left.where("pidx = 0"), right.where("pidx = 7"), 0.4, inclusive=True).count() == 1


def test_links(spark):
    links = F.array(F.lit(4), F.lit(0), F.lit(-1))
    first = lambda b, e, n: one(spark, matching.first_link(F.lit(b), F.lit(e), links, F.lit(n)))
    assert first(0, 1, 20) == 16 and first(0, 1, 16) is None and first(0, 0, 20) is None and first(2, 3, 20) is None and first(9, 10, 20) is None
    assert one(spark, matching.link_range(F.lit(1), F.lit(3), links)) == [0, -1] and one(spark, matching.link_range(F.lit(2), F.lit(1), links)) == []
    assert one(spark, matching.gather(links, F.array(F.lit(1), F.lit(7)))) == [0, None]


def test_fill_takes_the_last(spark):
    jets = spark.createDataFrame([(1, 0), (1, 1)], "event_id long, jet_id int")
    found = spark.createDataFrame([(1, 0, 3, 10), (1, 0, 5, 1)], "event_id long, jet_id int, tau_id int, decaymode int")
    out = matching.fill_last(jets, found, "jet_id", "tau_id", {"decaymode": -1}).collect()
    assert {r.jet_id: r.decaymode for r in out} == {0: 1, 1: -1}
    b = taus.background_info(jets, daughters=True).first()
    assert (b.decaymode, b.charge, b.DV_x, b.vis_daughter_p4s) == (-1, -999.0, 0.0, []) and b.p4.energy == b.full_p4.pt == 0.0


def test_array_helpers(spark):
    a = F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))
    assert one(spark, arrays.pad_or_clip(a, 5)) == [1.0, 2.0, 3.0, 0.0, 0.0] and one(spark, arrays.pad_or_clip(a, 2)) == [1.0, 2.0]
    assert one(spark, arrays.validity(a, 4)) == [True, True, True, False] and one(spark, arrays.at_least_one(F.array().cast("array<double>"))) == [-999.9]
    assert one(spark, arrays.pad_to(a, F.lit(4), -999.9)) == [1.0, 2.0, 3.0, -999.9] and one(spark, arrays.pad_to(a, F.lit(2), 0.0)) == [1.0, 2.0, 3.0]
    assert one(spark, arrays.one_hot(F.lit(2), 4)) == [0.0, 0.0, 1.0, 0.0]


def test_archival_filters_differ_at_zero(spark):
    part = F.array(F.struct(F.lit(1.0).alias("pt"), F.lit(2.0).alias("energy")))
    assert not one(spark, filters.good_archival_jet(F.lit(0.0), F.lit(0.0), F.lit(1.0), part)) and not one(spark, filters.bad_event_jet(F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    bad = F.array(F.struct(F.lit(1.0).alias("pt"), F.lit(45.6).alias("energy")))
    assert not one(spark, filters.good_archival_jet(F.lit(1.0), F.lit(0.0), F.lit(1.0), bad))


def test_split_is_exact_and_stable(spark):
    df = spark.range(1003).withColumn("g", F.col("id") % 2)
    a = sampling.split(df, ("id",), 0.9, by=("g",))
    n = {(r.g, r.split): r["count"] for r in a.groupBy("g", "split").count().collect()}
    assert n == {(0, "train"): 451, (0, "test"): 51, (1, "train"): 450, (1, "test"): 51}
    again = sampling.split(df.repartition(7), ("id",), 0.9, by=("g",))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, again.select(*a.columns).collect()))
    with pytest.raises(ValueError):
        sampling.merge_samples({})


def test_histogram_flows(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 0.5, 1.0, 2.0, 3.0, float("nan"), None)], "x double")
    get = lambda **k: {r.bin: r.value for r in histograms.hist_1d(df, "x", 0.0, 2.0, 2, **k).collect()}
    assert get() == {0: 2.0, 1: 2.0} and get(flow="bins") == {-1: 1.0, 0: 2.0, 1: 1.0, 2: 2.0} and get(flow="sum") == {0: 3.0, 1: 3.0}
    h = histograms.reverse_cumulative(histograms.hist_1d(df, "x", 0.0, 2.0, 2))
    assert {r.bin: r.value for r in h.collect()} == {0: 2.0, 1: 0.0}


def method_sizes(spark, df):
    """Bytes of the largest method of each generated stage; the JVM interprets methods of 8,000 or more."""
    import re

    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode))]


@pytest.mark.parametrize("name", ["lifetime_errors", "event_signed_impact"])
def test_lifetime_code_is_small_enough_to_be_compiled(spark, sf_dir, name):
    from jetloom.plans.queries import QUERIES

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = method_sizes(spark, QUERIES[name](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(sizes) < 8000


def test_closest_approach_of_missing_numbers(spark):
    names = ", ".join(f"{n} double" for n in lifetime.INPUTS)
    full = (0.02, 0.1, 0.3, 0.5, 0.0, 0.0, 0.0, 1e-4, 1e-6, 1e-4, 1e-6, 0.001, 0.002, 0.01)
    no_z = full[:-1] + (None,)
    nan_z = full[:-1] + (float("nan"),)
    rows = spark.createDataFrame([(i, *x) for i, x in enumerate((full, no_z, nan_z))], f"k int, {names}")
    a, b, c = lifetime.with_closest_approach(lifetime.with_closest_approach(rows), two_d=True, suffix="_2d").orderBy("k").collect()
    assert b.dxy is None and b.dz_2d is None and b.dxy_2d == a.dxy_2d and b.dxy_error_2d == a.dxy_error_2d > 0
    assert math.isnan(c.dxy) and math.isnan(c.dz_2d) and c.dxy_2d == a.dxy_2d
