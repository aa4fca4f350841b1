"""Recombination kernels against plain loops, and invariants."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import plain_clustering as c
from jetloom.operators import clustering as batched


def plain_jets(p4, radius):
    """Inclusive generalised kt with power -1, by nested loops."""
    live = {i: (list(map(float, p)), [i]) for i, p in enumerate(p4)}
    jets, n = [], len(p4)
    while live:
        best = None
        for i in sorted(live):
            w = live[i][0][0] ** -2.0
            cands = [((w, 1, i), (i, None))]
            for j in sorted(live):
                if j > i:
                    a, b = np.array(live[i][0][1:]), np.array(live[j][0][1:])
                    cos = max(-1.0, min(1.0, a @ b / np.linalg.norm(a) / np.linalg.norm(b)))
                    d = min(w, live[j][0][0] ** -2.0) * (1 - cos) / (1 - math.cos(radius))
                    cands.append(((d, 0, i), (i, j)))
            low = min(cands)
            best = low if best is None or low < best else best
        i, j = best[1]
        if j is None:
            jets.append(live.pop(i))
        else:
            a, b = live.pop(i), live.pop(j)
            live[n] = ([x + y for x, y in zip(a[0], b[0], strict=True)], a[1] + b[1])
            n += 1
    return sorted(sorted(own) for _, own in jets)


momenta = st.lists(st.tuples(st.floats(0.2, 10), st.floats(-2.4, 2.4), st.floats(-3.1, 3.1)), min_size=1, max_size=7)


@settings(max_examples=80, deadline=None)
@given(momenta)
def test_jets_equal_plain_loops(rows):
    p4 = c.massless(*[np.array(x) for x in zip(*rows, strict=True)])
    got = c.genkt_jets(p4, 0.4)
    assert sorted(own for _, own in got) == plain_jets(p4, 0.4)
    assert np.allclose(sum(p for p, _ in got), p4.sum(axis=0))


def test_small_events():
    assert c.genkt_jets(np.zeros((0, 4)), 0.4) == []
    a = c.massless(np.array([1.0, 2.0]), np.array([0.0, 0.0]), np.array([0.0, 0.01]))
    assert [own for _, own in c.genkt_jets(a, 0.4)] == [[0, 1]]
    b = c.massless(np.array([1.0, 2.0]), np.array([0.0, 0.0]), np.array([0.0, math.pi]))
    assert [own for _, own in c.genkt_jets(b, 0.4)] == [[1], [0]]


@settings(max_examples=60, deadline=None)
@given(momenta)
def test_shapes_stay_in_range(rows):
    pt, eta, phi = (np.array(x) for x in zip(*rows, strict=True))
    p4 = c.massless(pt, eta, phi)
    whole = c.invariant_mass(p4.sum(axis=0))
    for electron in (False, True):
        m = c.groomed_mass(p4, electron=electron)
        assert 0.0 <= m <= whole + 1e-6 and (len(pt) > 1 or m == 0.0)
    assert 0.0 <= c.subjettiness(pt, eta, phi, *c.iterated_axes(pt, eta, phi, 1)) <= 1.0 + 1e-9
    t = c.thrust(p4[:, 1:])
    p3 = p4[:, 1:]  # the iteration starts at the total momentum and never loses
    assert math.isnan(t) or np.linalg.norm(p3.sum(axis=0)) / np.linalg.norm(p3, axis=1).sum() - 1e-9 <= t <= 1.0 + 1e-9
    if len(pt) > 2:
        assert len(c.exclusive_axes(p4, 2)[0]) == 2 and len(c.exclusive_axes(p4, 1)[0]) == 1


def test_softdrop_drops_soft_wide_radiation():
    p4 = c.massless(np.array([10.0, 9.0, 0.1]), np.array([0.0, 0.1, 0.7]), np.array([0.0, 0.0, 0.5]))
    assert c.groomed_mass(p4) == pytest.approx(c.invariant_mass(p4[0] + p4[1]))


def test_cluster_partitions_particles_in_any_order(spark, sf_dir):
    from jetloom.sources import fixture

    p = fixture.particles(spark, sf_dir)
    key = lambda df: sorted((r.event_id, tuple(r.constituents)) for r in c.cluster(df).collect())
    got = key(p)
    assert got == key(p.repartition(3, "pidx"))
    assert sorted((e, i) for e, own in got for i in own) == sorted((r.event_id, r.pidx) for r in p.select("event_id", "pidx").collect())


def plain_turn(a, b):
    return math.remainder(a - b, 2 * math.pi)


def plain_place(v):
    return math.asinh(v[3] / math.hypot(v[1], v[2])), math.atan2(v[2], v[1])


def plain_tree(p4, distance, stop=1):
    """Nodes and splits of pairwise recombination until ``stop`` remain: {new: (i, j, distance)}."""
    nodes, live, split = [list(map(float, p)) for p in p4], list(range(len(p4))), {}
    while len(live) > stop:
        d, i, j = min((distance(nodes[i], nodes[j]), i, j) for a, i in enumerate(live) for j in live[a + 1 :])
        nodes.append([x + y for x, y in zip(nodes[i], nodes[j], strict=True)])
        split[len(nodes) - 1] = (i, j, d)
        live = [k for k in live if k not in (i, j)] + [len(nodes) - 1]
    return nodes, split


def plain_delta_r(a, b):
    (e1, f1), (e2, f2) = plain_place(a), plain_place(b)
    return math.hypot(e1 - e2, plain_turn(f1, f2))


def plain_cos(a, b):
    return sum(x * y for x, y in zip(a[1:], b[1:], strict=True)) / math.dist(a[1:], (0, 0, 0)) / math.dist(b[1:], (0, 0, 0))


def plain_energy(a, b):
    return min(a[0] ** -2, b[0] ** -2) * (1 - max(-1.0, min(1.0, plain_cos(a, b))))


@settings(max_examples=60, deadline=None)
@given(momenta)
def test_groomed_masses_equal_plain_loops(rows):
    p4 = c.massless(*[np.array(x) for x in zip(*rows, strict=True)])
    for distance, electron in ((plain_delta_r, False), (plain_energy, True)):
        nodes, split = plain_tree(p4, distance)
        at, want = len(nodes) - 1, None
        while at in split and want is None:
            i, j, _ = split[at]
            a, b = (math.hypot(*nodes[k][1:3]) for k in (i, j))
            if min(a, b) / (a + b) > 0.1:  # the exponent of the angle is 0
                want = at
            else:
                at = i if a >= b else j
        v = nodes[at]
        mass = math.sqrt(max(0.0, v[0] ** 2 - v[1] ** 2 - v[2] ** 2 - v[3] ** 2)) if len(p4) > 1 else 0.0
        assert c.groomed_mass(p4, electron=electron) == pytest.approx(mass, abs=1e-4)


@settings(max_examples=60, deadline=None)
@given(momenta, st.integers(1, 4))
def test_axes_and_subjettiness_equal_plain_loops(rows, n):
    pt, eta, phi = (np.array(x) for x in zip(*rows, strict=True))
    n = min(n, len(rows))
    order = sorted(range(len(rows)), key=lambda i: -rows[i][0])[:n]
    axes = [(rows[i][1], rows[i][2]) for i in order]
    for _ in range(5):
        own = [min(range(n), key=lambda k: (math.hypot(e - axes[k][0], plain_turn(f, axes[k][1])), k)) for _, e, f in rows]
        moved = []
        for k in range(n):
            mine = [r for r, o in zip(rows, own, strict=True) if o == k]
            total = sum(r[0] for r in mine)
            moved.append((sum(r[0] * r[1] for r in mine) / (total or 1.0), math.atan2(sum(r[0] * math.sin(r[2]) for r in mine), sum(r[0] * math.cos(r[2]) for r in mine))))
        axes = moved
    a_eta, a_phi = c.iterated_axes(pt, eta, phi, n)
    assert np.allclose(sorted(a_eta), sorted(a for a, _ in axes), atol=1e-6)
    want = sum(r[0] * min(0.8, min(math.hypot(r[1] - e, plain_turn(r[2], f)) for e, f in axes)) for r in rows) / (0.8 * sum(r[0] for r in rows))
    assert c.subjettiness(pt, eta, phi, a_eta, a_phi) == pytest.approx(want, abs=1e-6)


def test_exclusive_axes_equal_plain_loops():
    rng = np.random.default_rng(4)
    for n in (2, 3):
        for _ in range(40):
            p4 = c.massless(rng.uniform(1, 9, 6), rng.normal(0, 0.15, 6), rng.normal(0, 0.15, 6))  # near each other: pairs come before the beam
            nodes, split = plain_tree(p4, plain_energy, n)
            gone = {i for s in split.values() for i in s[:2]}
            want = sorted(plain_place(v) for k, v in enumerate(nodes) if k not in gone)
            eta, phi = c.exclusive_axes(p4, n)
            assert np.allclose(sorted(zip(eta, phi, strict=True)), want)


@settings(max_examples=60, deadline=None)
@given(momenta)
def test_thrust_equals_plain_loops(rows):
    p3 = [(pt * math.cos(phi), pt * math.sin(phi), pt * math.sinh(eta)) for pt, eta, phi in rows]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    unit = lambda v: tuple(x / math.sqrt(dot(v, v)) for x in v)
    n = unit([sum(x) for x in zip(*p3, strict=True)])
    for _ in range(100):
        new = unit([sum(math.copysign(1, dot(p, n)) * p[k] for p in p3) for k in range(3)])
        if all(abs(a - b) < 1e-9 for a, b in zip(new, n, strict=True)):
            break
        n = new
    want = sum(abs(dot(p, n)) for p in p3) / sum(math.sqrt(dot(p, p)) for p in p3)
    padded = np.zeros((2, len(rows) + 2, 3))
    padded[0, : len(rows)] = p3
    got = c.batched_thrust(padded)
    assert c.thrust(np.array(p3)) == pytest.approx(want, abs=1e-4) and got[0] == pytest.approx(want, abs=1e-4) and np.isnan(got[1])


@settings(max_examples=60, deadline=None)
@given(st.lists(momenta, min_size=1, max_size=6), st.sampled_from([0.4, 0.8, 3.5]))
def test_batched_jets_equal_single_events(events, radius):
    vectors = [c.massless(*[np.array(x) for x in zip(*rows, strict=True)]) for rows in events] + [np.zeros((0, 4))]
    for got, p4 in zip(batched.jets_of_events(vectors, radius), vectors, strict=True):
        want = c.genkt_jets(p4, radius)
        assert [own for _, own in got] == [own for _, own in want] and all(np.allclose(a, b) for (a, _), (b, _) in zip(got, want, strict=True))


def random_jets(seed, sizes):
    rng = np.random.default_rng(seed)
    return [np.column_stack([rng.exponential(2, n) + 0.05, rng.normal(0, 0.3, n), rng.normal(0, 0.3, n)]) for n in sizes]


@pytest.mark.parametrize("sizes", [[1, 2, 3, 4, 5, 5, 5, 8, 0, 30], [60, 60], [300]])
def test_batched_trees_equal_single_jets(sizes):
    jets = random_jets(len(sizes), sizes)
    made = batched.substructure_of(jets)
    for got, jet in zip(made, jets, strict=True):
        if len(jet):
            assert np.allclose(got, c.substructure_of(*jet.T), atol=1e-6)
        else:
            assert np.isnan(got).all()
    for rows, jet in zip(batched.jets_of_events([batched.massless(*j.T) for j in jets], 0.4), jets, strict=True):
        assert [own for _, own in rows] == [own for _, own in c.genkt_jets(batched.massless(*jet.T), 0.4)]


def test_objects_without_momentum_or_energy_and_ties():
    still = np.array([[1.0, 0, 0, 0], [0.0, 0, 0, 0], [2.0, 1, 0, 0], [2.0, 1, 0, 0], [2.0, 1, 0, 0]])
    for p4 in (still, still[::-1], still[2:]):
        got = batched.jets_of_events([p4, p4], 0.4)
        assert [own for _, own in got[0]] == [own for _, own in got[1]] == [own for _, own in c.genkt_jets(p4, 0.4)]


def test_memory_of_a_batch_has_a_bound(monkeypatch):
    """4,096 events of 300 particles: what is held at once follows the budget and not the events' pairs."""
    import tracemalloc

    rng = np.random.default_rng(1)
    one = batched.massless(rng.exponential(2, (4096, 300)) + 0.05, rng.normal(0, 1, (4096, 300)), rng.uniform(-3, 3, (4096, 300)))
    monkeypatch.setattr(batched, "BUDGET", 64 << 20)
    work = list(batched._by_size(list(one)))
    assert len(work) > 4 and sum(len(part) for part, _ in work) == 4096
    tracemalloc.start()
    h = batched.recombined(work[0][1], batched.energy_metric(0.1), batched.weight)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20 and (h.right < 0).any(axis=1).all()


def test_only_the_kernels_lists_go_to_python(spark):
    from pyspark.sql import functions as F

    rows = spark.range(3).select(F.col("id").alias("event_id"), F.array(F.struct(*[F.lit(1.0).alias(x) for x in ("energy", "px", "py", "pz", "pt", "eta", "phi")], F.lit("kept").alias("rest"))).alias("c"))
    plan = batched.with_substructure(batched.with_jets(rows, {"c": 0.4}), "c")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
    out = batched.with_jets(rows, {"c": 0.4}).select("c.rest", F.size("c_jets").alias("n")).collect()
    assert [(r.rest, r.n) for r in out] == [(["kept"], 1)] * 3


def test_substructure_query_equals_single_jets_over_the_whole_table(spark, sf_dir):
    from jetloom.plans.queries import QUERIES
    from jetloom.sources import fixture

    particles = {(r.event_id, r.pidx): (r.pt, r.eta, r.phi) for r in fixture.particles(spark, sf_dir).collect()}
    jets = {(r.event_id, r.jet_id): r.constituents for r in c.cluster(fixture.particles(spark, sf_dir), 0.8).collect()}
    rows = {(r.event_id, r.jet_id): r for r in QUERIES["jets_substructure"](spark, sf_dir).collect()}
    assert rows.keys() == jets.keys() and len(rows) > 1000
    for key, own in jets.items():
        want = c.substructure_of(*np.array([particles[key[0], i] for i in sorted(own)]).T)
        assert np.allclose([rows[key][n] for n in batched.SUBSTRUCTURE], want, atol=1e-5)


def test_distances_are_those_of_the_definition_bit_by_bit():
    """Pairs that are equally far but for rounding are decided by the order of operations: (a . b) / (|a| |b|) and 1 / e**2."""
    rng = np.random.default_rng(3)
    p = rng.normal(size=(400, 2, 4))
    p[..., 0] = np.abs(p[..., 0]) + 1
    metric = batched.energy_metric(0.3)
    found = metric.pair(metric.features(p[:, 0]), metric.features(p[:, 1]))
    for (a, b), d in zip(p.tolist(), found.tolist(), strict=True):
        size = [math.sqrt(x[1] * x[1] + x[2] * x[2] + x[3] * x[3]) for x in (a, b)]
        dot = (a[1] * b[1] + a[2] * b[2] + a[3] * b[3]) / (size[0] * size[1])
        assert d == min(1 / (a[0] * a[0]), 1 / (b[0] * b[0])) * (1 - max(-1.0, min(1.0, dot))) / 0.3


def test_named_substructure_alone_is_made():
    rng = np.random.default_rng(4)
    groups = batched.Groups.of([np.abs(rng.normal(size=(n, 3))) for n in (0, 1, 2, 5, 5, 9)], 3)
    whole = batched.substructure_in(groups)
    names = ("tau2_ee", "sdmass")
    assert np.array_equal(batched.substructure_in(groups, names=names), whole[:, [batched.SUBSTRUCTURE.index(n) for n in names]], equal_nan=True)
