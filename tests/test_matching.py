"""Nearest objects where rounding decides."""

from __future__ import annotations

import math

import numpy as np

from jetloom.operators import matching


def test_ties_and_limits_are_decided_by_the_c_library_and_not_by_another_rounding(spark):
    rng = np.random.default_rng(1)
    events = [([(int(e), round(float(p), 0)) for e, p in zip(rng.integers(-5, 5, 4), rng.integers(-180, 180, 4), strict=True)], [(int(e), round(float(p), 0)) for e, p in zip(rng.integers(-5, 5, 6), rng.integers(-180, 180, 6), strict=True)]) for _ in range(2000)]
    place = lambda o: (o[0] / 10.0, o[1] % 6 * 10 * math.pi / 180.0)  # noqa: E731  a coarse grid: many equal distances
    left = [(e, k, *place(o)) for e, (a, _) in enumerate(events) for k, o in enumerate(a)]
    right = [(e, k, *place(o)) for e, (_, b) in enumerate(events) for k, o in enumerate(b)]
    schema = "event_id long, pidx int, eta double, phi double"
    for inclusive in (False, True):
        found = matching.nearest(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), 0.4, inclusive=inclusive).collect()
        got = {(r.event_id, r.left_id): (r.right_id, r.dr) for r in found}
        want = {}
        for e, k, eta, phi in left:
            dr, at = min((math.sqrt(math.pow(eta - y, 2.0) + math.pow(math.atan2(math.sin(phi - z), math.cos(phi - z)), 2.0)), j) for _, j, y, z in right[6 * e : 6 * e + 6])
            if dr < 0.4 or (inclusive and dr <= 0.4):
                want[e, k] = (at, dr)
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert all(abs(got[k][1] - v[1]) < 1e-12 for k, v in want.items())


def test_mirrored_objects_at_whole_degrees_are_ordered_as_in_sql(spark):
    """Two objects 23 degrees to either side: which is nearer by the last bit depends on the library's arc tangent."""
    import duckdb

    at = lambda k: (k - 180) * math.pi / 180.0
    left = [(k, 0, 0.0, at(k)) for k in range(23, 337)]
    right = [(k, j, 0.1, at(k + d)) for k in range(23, 337) for j, d in enumerate((23, -23))]
    schema = "event_id long, pidx int, eta double, phi double"
    found = matching.nearest(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), 0.8).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE a (e BIGINT, i INT, eta DOUBLE, phi DOUBLE); CREATE TABLE b AS FROM a LIMIT 0")
    con.executemany("INSERT INTO a VALUES (?, ?, ?, ?)", left)
    con.executemany("INSERT INTO b VALUES (?, ?, ?, ?)", right)
    dr = "sqrt(pow(a.eta - b.eta, 2) + pow(atan2(sin(a.phi - b.phi), cos(a.phi - b.phi)), 2))"
    want = con.execute(f"SELECT e, i FROM (SELECT a.e, b.i, row_number() OVER (PARTITION BY a.e ORDER BY {dr}, b.i) AS k FROM a JOIN b ON a.e = b.e) WHERE k = 1").fetchall()
    assert {(r.event_id, r.right_id) for r in found} == {*want}


def test_assignment_keeps_jets_without_particles_and_events_without_any(spark):
    jets = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 5.0, 0.0), (2, 0, 0.0, 0.0)], "event_id long, jet_id int, eta double, phi double")
    particles = spark.createDataFrame([(1, 1, 0.1, 0.0), (1, 0, 0.0, 0.1), (3, 0, 0.0, 0.0)], "event_id long, pidx int, eta double, phi double")
    rows = sorted((r.event_id, r.jet_id, r.n_particles, r.particles) for r in matching.assign(particles, jets).collect())
    assert rows == [(1, 0, 2, [0, 1]), (1, 1, 0, []), (2, 0, 0, [])]


def test_half_a_turn_has_the_sign_that_the_c_library_gives(spark):
    from jetloom.operators import shapes

    rng = np.random.default_rng(7)
    rows = []
    for k in rng.integers(0, 360, 3000).tolist():
        phi, size = (k - 180) * math.pi / 180.0, float(rng.uniform(0.1, 9))
        rows.append((phi, -size * math.cos(phi), -size * math.sin(phi)))
    df = spark.createDataFrame(rows, "phi double, jet_px double, jet_py double").selectExpr("*", "atan2(jet_py, jet_px) AS jet_phi")
    for r in df.withColumn("turn", shapes.phirel()).collect():
        d = r.phi - math.atan2(r.jet_py, r.jet_px)
        assert r.turn == math.atan2(math.sin(d), math.cos(d))
