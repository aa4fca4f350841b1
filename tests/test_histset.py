"""Declared sets of histograms against NumPy and against the tables one by one."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from jetloom.functions.p4 import digitize
from jetloom.operators import histograms
from jetloom.operators.histset import Axis, Table, edges_of, filled, log_axis, shares, standard_tables


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    data = [(int(i % 2), float(x), float(y), [float(v) for v in vs]) for i, (x, y, vs) in enumerate(zip(rng.normal(1, 2, 400), rng.exponential(3, 400), [rng.exponential(1, rng.integers(0, 5)) for _ in range(400)], strict=True))]
    data += [(0, float("nan"), 1.0, [float("nan"), -999.0]), (1, None, None, None), (0, 5.0, 0.0, []), (1, -3.0, 100.0, [0.0])]
    return spark.createDataFrame(data, "k int, x double, y double, vs array<double>")


def read(df):
    return {(r.k, r.name, r.x_bin, r.y_bin): (r.n, round(r.value, 6)) for r in df.collect()}


def test_uniform_free_and_flow_equal_the_single_tables(rows):
    free = (-1.0, 0.0, 0.5, 4.0)
    tables = [
        Table("drop", "x", Axis(-3.0, 5.0, 16)),
        Table("bins", "x", Axis(-3.0, 5.0, 16, flow="bins")),
        Table("sum", "x", Axis(-3.0, 5.0, 16, flow="sum"), weight="y"),
        Table("free", "x", Axis(edges=free)),
    ]
    got = read(filled(rows, tables, ("k",)))
    for name, single in {
        "drop": histograms.hist_1d(rows, "x", -3.0, 5.0, 16, keys=("k",)),
        "bins": histograms.hist_1d(rows, "x", -3.0, 5.0, 16, flow="bins", keys=("k",)),
        "sum": histograms.hist_1d(rows, "x", -3.0, 5.0, 16, weight="y", flow="sum", keys=("k",)),
        "free": histograms.hist_edges(rows, "x", list(free), keys=("k",)),
    }.items():
        want = {(r.k, r.bin): round(r.value, 6) for r in single.collect() if r.value}
        assert {(k, b): v[1] for (k, n, b, _), v in got.items() if n == name and v[1]} == want


def test_two_dimensions_with_log_axes_equal_numpy(rows):
    table = Table("map", "y", log_axis(-2.0, 2.0, 8), "x", Axis(edges=(-4.0, 0.0, 1.0, 9.0)), weight=F.col("x") * 2)
    got = read(filled(rows, [table], ("k",)))
    data = [r for r in rows.collect() if r.k == 0 and r.x is not None and not np.isnan(r.x)]
    x, y = np.array([r.x for r in data]), np.array([r.y for r in data])
    want, *_ = np.histogram2d(y, x, bins=[np.logspace(-2, 2, 9), [-4.0, 0.0, 1.0, 9.0]], weights=2 * x)
    for i in range(8):
        for j in range(3):
            assert got.get((0, "map", i, j), (0, 0.0))[1] == pytest.approx(want[i, j], abs=1e-5)


def test_elements_of_lists_and_axes_from_the_data(rows):
    element = lambda e: e
    tables = [
        Table("each", element, Axis(bins=10, spans="k = 0"), where=lambda e: e > -900, each="vs"),
        Table("log", element, Axis(bins=7, spans="true", log=True), each="vs"),
        Table("range", "x", Axis(bins=5, spans=F.col("k") == 1)),
        Table("top", "y", Axis(bins=4, spans="true", top_of=F.greatest("x", "y"))),
    ]
    got = read(filled(rows, tables, ("k",)))
    data = rows.collect()
    vs = {k: np.array([v for r in data if r.k == k for v in r.vs or [] if v > -900]) for k in (0, 1)}
    for k in (0, 1):
        want, _ = np.histogram(vs[k], 10, (vs[0].min(), vs[0].max()))
        assert [got.get((k, "each", i, None), (0,))[0] for i in range(10)] == want.tolist()
    positive = np.concatenate([v[v > 0] for v in vs.values()])
    assert sum(v[0] for (_, n, _, _), v in got.items() if n == "log") == len(positive)
    ones = np.array([r.x for r in data if r.k == 1 and r.x is not None])
    assert [got.get((1, "range", i, None), (0,))[0] for i in range(5)] == np.histogram(ones, 5, (ones.min(), ones.max()))[0].tolist()
    top = max(max(r.x, r.y) for r in data if r.x is not None and not np.isnan(r.x))
    assert {r.hi for r in edges_of(rows, tables).where("name = 'top' and bin = 3").collect()} == {top}


def test_one_scan_and_one_exchange(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    tables = [Table(f"t{i}", "x", Axis(0.0, 5.0, 5 + i)) for i in range(12)] + [Table("v", lambda e: e, Axis(), each="vs")]
    plan = filled(stored, tables, ("k",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_sums_of_weights_do_not_hang_on_the_order_of_rows(spark):
    weights = [0.1] * 10 + [k / 1e6 for k in range(90_000, 10_500_000, 9973)] + [-3.3, 1e-9]
    for ws in (weights, weights[::-1], sorted(weights, key=lambda w: w % 0.001)):
        df = spark.createDataFrame([(w,) for w in ws], "w double").repartition(3)
        (row,) = filled(df, [Table("t", F.lit(0.5), Axis(), weight="w")]).collect()
        assert row.value == math.fsum(weights)
    for ws in ([1e300, 1.0], [math.inf, 1.0], [2.0**33, 0.5]):
        (row,) = filled(spark.createDataFrame([(w,) for w in ws], "w double"), [Table("t", F.lit(0.5), Axis(), weight="w")]).collect()
        assert row.value == sum(ws)


def test_shares_names_and_empty(spark, rows):
    tables = [Table("a", "x", Axis(-3.0, 5.0, 4)), Table("b", "y", Axis(0.0, 9.0, 3), weight="y")]
    sums = shares(filled(rows, tables)).groupBy("name").agg(F.sum("n_share").alias("n"), F.sum("value_share").alias("v")).collect()
    assert all(r.n == pytest.approx(1) and r.v == pytest.approx(1) for r in sums)
    assert filled(rows.limit(0), [*tables, Table("c", "x", Axis(spans="true", log=True))]).count() == 0
    with pytest.raises(ValueError, match="names"):
        filled(rows, [tables[0], tables[0]])
    with pytest.raises(ValueError, match="second axis"):
        Table("d", "x", Axis(), y="y")
    with pytest.raises(ValueError, match="flow"):
        Axis(flow="other")
    with pytest.raises(ValueError, match="ascend"):
        Axis(edges=(0.0, 0.0, 1.0))


def test_tables_whose_columns_are_missing_are_left_out():
    assert standard_tables(["event_id"]) == []
    names = {t.name for t in standard_tables(["gen_jet_p4", "reco_cand_dz"])}
    assert names == {"gen_jet_pt", "gen_jet_eta", "gen_jet_theta", "gen_jet_p", "gen_jet_mass", "reco_cand_dz"}


def test_values_on_and_beside_the_edges_of_a_log_axis_are_placed_as_by_a_look_at_every_edge(spark):
    axis = log_axis(-3.0, 1.0, 79, "bins")
    edges = axis.all_edges()
    values = [v for e in edges for v in (e, math.nextafter(e, 0), math.nextafter(e, 99), e * 1.01)] + [0.0, -1.0, 1e-300, 1e300, math.inf]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(axis.place(F.col("x")).alias("got"), (digitize("x", edges) - 1).alias("want"))
    assert all(r.got == r.want for r in df.collect())


def test_a_condition_on_the_row_spares_the_list(spark):
    df = spark.createDataFrame([(1, [0.5, 0.6]), (2, [0.7]), (None, [0.8])], "k int, vs array<double>")
    for where in (F.col("k") == 1, "one"):
        plan = filled(df.withColumn("one", F.col("k") == 1), [Table("t", lambda e: e, Axis(), where=where, each="vs")])
        assert [(r.n, r.x_bin) for r in plan.orderBy("x_bin").collect()] == [(1, 25), (1, 30)]
