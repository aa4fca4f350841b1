"""Results that hang on the last bit of a sine or an angle, against SQL."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import functions as F

from jetloom.operators import matching
from jetloom.plans import oracles, pipelines, queries
from jetloom.sources import fixture

LINES = """(55118, 2, 2602, 801, '1995-05-21', 31, 24332.35, 0.09, 0.02, 'R', 'O'), (55118, 2, 11281, 210, '1997-10-16', 49, 59602.74, 0.09, 0.04, 'A', 'F'),
 (55118, 3, 12904, 3, '2001-04-18', 33, 48467.56, 0.01, 0.01, 'R', 'F'), (55118, 4, 1851, 719, '2000-05-31', 43, 95639.3, 0.01, 0.05, 'R', 'O'),
 (55118, 4, 9703, 348, '2001-09-15', 44, 53199.87, 0.07, 0.06, 'A', 'O'), (55118, 7, 11280, 935, '1999-06-22', 31, 4626.9, 0.05, 0.07, 'N', 'O'),
 (55118, 7, 19803, 652, '2000-03-07', 19, 36120.84, 0.04, 0.07, 'N', 'O'), (144269, 1, 7932, 631, '1998-04-14', 45, 25868.22, 0.07, 0.0, 'N', 'O'),
 (144269, 2, 18888, 525, '1996-01-24', 14, 44113.53, 0.08, 0.04, 'A', 'O'), (144269, 3, 10725, 710, '1999-03-18', 7, 62344.19, 0.02, 0.02, 'A', 'O'),
 (144269, 5, 8630, 543, '1995-03-02', 45, 13588.41, 0.09, 0.02, 'R', 'O'), (144269, 5, 12166, 958, '1996-12-14', 30, 90664.56, 0.09, 0.07, 'A', 'F'),
 (144269, 7, 8609, 740, '1998-05-09', 45, 19410.54, 0.03, 0.04, 'N', 'O'), (144269, 7, 18039, 146, '1997-04-30', 43, 6382.59, 0.09, 0.06, 'R', 'O')"""
NAMES = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
KINDS = "BIGINT, INTEGER, BIGINT, BIGINT, TIMESTAMP, DOUBLE, DOUBLE, DOUBLE, DOUBLE, VARCHAR, VARCHAR"


def tables(where, lines, orders):
    con = duckdb.connect()
    kinds = ", ".join(f"CAST({n} AS {k}) AS {n}" for n, k in zip(NAMES.split(", "), KINDS.split(", "), strict=True))
    con.execute(f"COPY (SELECT {kinds} FROM (VALUES {lines}) t({NAMES})) TO '{where}/lineitem.parquet'")
    con.execute(f"COPY (SELECT CAST(k AS BIGINT) AS o_orderkey, CAST(c AS BIGINT) AS o_custkey FROM (VALUES {orders}) t(k, c)) TO '{where}/orders.parquet'")
    for name in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {name} AS FROM '{where}/{name}.parquet'")
    return con


def test_particles_equally_far_from_two_stored_jets_go_where_sql_puts_them(spark, tmp_path):
    con = tables(tmp_path, LINES, "(55118, 3471), (144269, 7749)")
    found = con.execute(oracles.oracle_sql()["stored_archival_jets"])
    names = [c[0] for c in found.description]
    assert sorted(tuple(r[c] for c in names) for r in queries.stored_archival_jets(spark, str(tmp_path)).collect()) == sorted(found.fetchall())


def test_momenta_are_those_of_the_c_library(spark, tmp_path):
    lines = ", ".join(f"({k}, 1, {k}, 0, '1995-01-01', {k % 50 + 1}, 1234.56, 0, 0, 'A', 'F')" for k in range(360))
    con = tables(tmp_path, lines, "(0, 0)")
    want = con.execute(f"WITH {oracles.P} SELECT event_id, px, py, pz, tanl, energy FROM p").fetchall()
    got = fixture.particles(spark, str(tmp_path)).select("event_id", "px", "py", "pz", "tanl", "energy").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    off = con.sql("SELECT * REPLACE (0.25 + l_quantity AS l_quantity) FROM lineitem").to_parquet(f"{tmp_path}/off.parquet")  # noqa: F841  not on the grid
    con.execute(f"CREATE OR REPLACE VIEW lineitem AS FROM '{tmp_path}/off.parquet'")
    (tmp_path / "lineitem.parquet").unlink()
    (tmp_path / "off.parquet").rename(tmp_path / "lineitem.parquet")
    got = fixture.particles(spark, str(tmp_path)).select("eta", "pt", "pz", "tanl").collect()
    assert len(got) == 360 and all(math.isclose(r.tanl, math.sinh(r.eta), rel_tol=1e-14) and math.isclose(r.pz, r.pt * r.tanl, rel_tol=1e-14) for r in got)


def test_objects_without_a_direction_are_not_matched_by_their_momenta(spark):
    rows = [(0, [(1.0, 0.0, 0.0), (0.0, 0.0, 2.0), (0.0, 0.0, 0.0)], [(0.0, 0.0), (math.inf, 0.0)]), (1, [(1.0, 0.0, 0.0)], []), (2, [], [(0.0, 0.0)])]
    df = spark.createDataFrame(rows, "k int, l array<struct<px: double, py: double, pz: double>>, r array<struct<eta: double, phi: double>>")
    at = matching.nearest_in_lists("l", "r", 0.8, by=(matching.MOMENTA, matching.ANGLES))["at"]
    assert [r.at for r in df.select("k", at.alias("at")).orderBy(F.col("k")).collect()] == [[0, -1, 0], [-1], []]


def test_jets_just_within_or_beyond_the_cone_are_matched_as_in_sql(spark):
    """Two jets at one azimuth whose eta differs by 0.4: which are nearer than that is a matter of the last bit."""
    v = lambda k, phi: (math.cos(phi), math.sin(phi), math.sinh(k / 10.0), math.cosh(k / 10.0))
    events = [(k * 1000 + d, v(k, (d - 180) * math.pi / 180.0), v(k + 4, (d - 180) * math.pi / 180.0)) for k in range(-20, 20) for d in range(0, 360, 4)]
    kinds = "event_id long, reco array<struct<px: double, py: double, pz: double, energy: double>>, gen array<struct<pdg: int, px: double, py: double, pz: double, energy: double>>"
    df = spark.createDataFrame([(e, [a], [(211, *b)]) for e, a, b in events], kinds)
    found = {r.event_id for r in pipelines.matched_jets(df, pipelines.NtupleConfig(signal=False)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (e BIGINT, ax DOUBLE, ay DOUBLE, az DOUBLE, bx DOUBLE, by_ DOUBLE, bz DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?, ?)", [(e, *a[:3], *b[:3]) for e, a, b in events])
    angles = ", ".join(f"asinh({s}z/sqrt({s}x*{s}x + {y}*{y})) AS {s}eta, atan2({y}, {s}x) AS {s}phi" for s, y in (("a", "ay"), ("b", "by_")))
    want = {e for (e,) in con.execute(f"SELECT e FROM (SELECT e, {angles} FROM t) WHERE {oracles.dr('aeta', 'aphi', 'beta', 'bphi')} < 0.4").fetchall()}
    assert found == want and 0 < len(want) < len(events)


def test_sums_on_half_a_unit_are_rounded_as_in_sql(spark):
    con = duckdb.connect()
    values = [16.55175, -16.55175, 0.0, 1.5, 123456789.00005, *[k / 100_000 for k in range(5, 2_000_000, 970)]]
    con.execute("CREATE TABLE t (k BIGINT, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    want = con.execute("SELECT k, round(x, 4) + 0.0 FROM t").fetchall()
    df = spark.createDataFrame(list(enumerate(values)), "k long, x double")
    assert sorted(map(tuple, df.select("k", queries.r_by_power("x", 4)).collect())) == sorted(want)
    plain = dict(map(tuple, df.select("k", queries.r("x", 4)).collect()))
    assert plain[0] != dict(want)[0]


def test_jets_at_the_end_of_an_axis_are_counted_as_in_sql(spark, tmp_path):
    """Jets of one particle at the least eta: the last bit decides whether a signal jet is on an axis that ends at a background jet."""

    def eta(cents, degree):
        pt, phi = cents / 100.0 / 10000.0, (degree - 180) * math.pi / 180.0
        px, py = pt * math.cos(phi), pt * math.sin(phi)
        return math.asinh(pt * math.sinh((1 - 25.5) / 10.0) / math.sqrt(px * px + py * py))

    found = {eta(c, d): (c, d) for c in range(900_00, 900_00 + 400 * 9973, 9973) for d in range(360)}
    inside, beyond = found[-2.45], found[min(found)]
    assert min(found) < -2.45
    line = lambda k, at, quantity, flag: f"({k}, 1, {at[1] * 253 % 360}, 0, '1995-01-01', {quantity}, {at[0] / 100.0}, 0.02, 0.03, '{flag}', 'F')"  # noqa: E731  37 * 253 leaves 1
    other = [line(2, (7_000_000, 11), 50, "A"), line(3, inside, 20, "R"), *[line(4, (3_000_000 + d * 7919, d), 9, "A") for d in (50, 80)]]
    con = tables(tmp_path, ", ".join([line(0, inside, 1, "A"), line(1, beyond, 1, "R"), *other]), "(0, 0), (1, 1), (2, 2), (3, 3), (4, 4)")
    want = con.execute(f"SELECT is_signal, name, x_bin, y_bin, n FROM ({oracles.oracle_sql()['validation_one_scan']})").fetchall()
    got = queries.validation_one_scan(spark, str(tmp_path)).select("is_signal", "name", "x_bin", "y_bin", "n").collect()
    key = lambda r: tuple(-9 if x is None else x for x in r)
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert sum(r[4] for r in want if r[1] == "gen_jet_eta") == 4
