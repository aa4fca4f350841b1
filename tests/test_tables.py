"""SQL table functions: the same rows as the operators, and wrong arguments refused before a job runs."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from jetloom.functions import tables
from jetloom.operators import clustering
from jetloom.sources import fixture


@pytest.fixture(scope="module")
def view(spark, sf_dir):
    tables.register(spark)
    p = fixture.particles(spark, sf_dir).where("event_id % 5 = 0")
    p.createOrReplaceTempView("particles")
    return p


def test_jets_and_thrust_equal_the_operators(spark, view):
    got = spark.sql("SELECT * FROM jets(TABLE(SELECT event_id, pidx, energy, px, py, pz FROM particles) PARTITION BY (event_id), 0.4)")
    key = lambda r: (r.event_id, r.jet_id, tuple(r.constituents), round(r.energy, 8), round(r.px, 8))
    assert sorted(map(key, got.collect())) == sorted(map(key, clustering.cluster(view, 0.4).collect()))
    assert got.schema["event_id"].dataType == view.schema["event_id"].dataType
    got = spark.sql("SELECT * FROM thrust(TABLE(SELECT event_id, px, py, pz FROM particles) PARTITION BY event_id)")
    rounded = lambda df: {r.event_id: round(r.thrust, 5) for r in df.collect()}
    assert rounded(got) == rounded(clustering.event_thrust(view)) and len(rounded(got)) > 50


def test_substructure_by_any_key(spark, view):
    statement = "SELECT * FROM substructure(TABLE(SELECT cast(event_id AS string) AS jet_key, pt, eta, phi FROM particles) PARTITION BY (jet_key), 0.8)"
    got = {int(r.jet_key): r for r in spark.sql(statement).collect()}
    want = {r.event_id: r for r in clustering.substructure(view, ("event_id",)).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][n] == pytest.approx(want[k][n], abs=1e-6) for k in want for n in clustering.SUBSTRUCTURE)


@pytest.mark.parametrize(
    "call, why",
    [
        ("jets(TABLE(SELECT event_id, pidx FROM particles) PARTITION BY (event_id), 0.4)", "lacks energy, px, py, pz"),
        ("jets(TABLE(SELECT event_id, pidx, 'x' AS energy, px, py, pz FROM particles) PARTITION BY (event_id), 0.4)", "energy must be numbers"),
        ("jets(TABLE(SELECT * FROM particles) PARTITION BY (event_id), -1.0)", "positive constant"),
        ("thrust(TABLE(SELECT px, py, pz FROM particles) PARTITION BY px)", "lacks event_id"),
        ("thrust(1)", "TABLE"),
    ],
)
def test_wrong_arguments_are_refused_at_analysis(spark, view, call, why):
    with pytest.raises(AnalysisException, match=why):
        spark.sql(f"SELECT * FROM {call}").schema  # noqa: B018


def test_one_events_thrust_is_that_of_the_batch():
    import numpy as np

    from jetloom.operators import clustering

    rng = np.random.default_rng(5)
    events = [rng.normal(size=(n, 3)) for n in (1, 2, 3, 5, 17, 99, 101) for _ in range(50)] + [np.zeros((2, 3)), np.array([[1.0, 0, 0], [-1.0, 0, 0]])]
    one = [clustering.single_thrust([tuple(r) for r in e.tolist()]) for e in events]
    assert np.allclose(one, clustering.thrust_of(events), atol=1e-12, equal_nan=True) and np.isnan(one[-2:]).all()


def test_one_events_jets_are_those_of_the_batch_bit_by_bit():
    import time

    import numpy as np

    rng = np.random.default_rng(11)
    events = []
    for n in (1, 2, 3, 4, 7, 13, 30):
        for k in range(60):
            p = rng.normal(size=(n, 3)) if k % 2 else rng.integers(-2, 3, (n, 3)).astype(float)  # many equal distances and energies, and no momentum
            e = np.sqrt((p * p).sum(axis=1) + (k % 3) * 0.01)
            events.append(np.column_stack([np.where(k % 5, e, np.round(e)), p]))
    for radius in (0.4, 0.8, 3.5):
        want = clustering.jets_of_events(events, radius)
        got = [clustering.single_jets([tuple(r) for r in e.tolist()], radius) for e in events]
        assert [[(tuple(p.tolist()), own) for p, own in jets] for jets in want] == got
    few = [e for e in events if len(e) <= 7]
    began = time.perf_counter()
    for e in few:
        clustering.jets_of_events([e], 0.4)
    arrays, began = time.perf_counter() - began, time.perf_counter()
    for e in few:
        clustering.single_jets([tuple(r) for r in e.tolist()], 0.4)
    assert time.perf_counter() - began < arrays / 3


def test_jets_of_whole_events_are_those_of_rows(spark, view):
    statement = "SELECT * FROM event_jets(TABLE(SELECT event_id, array_sort(collect_list(struct(pidx, energy, px, py, pz))) AS particles FROM particles GROUP BY event_id UNION ALL SELECT -1L, NULL), 0.4)"
    got = spark.sql(statement)
    want = clustering.cluster(view, 0.4)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.select(got.columns).schema]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    with pytest.raises(Exception, match="positive constant"):
        spark.sql(statement.replace("0.4)", "-0.4)")).collect()
