"""Flows, readers, writers and file-incremental runs."""

from __future__ import annotations

import math

import numpy as np
import plain_clustering
import pytest
from pyspark.sql import functions as F

from jetloom.operators import filters, lifetime, sampling, taus, weights
from jetloom.plans import pipelines, queries
from jetloom.sources import events as events_
from jetloom.sources import fixture, readers, sinks
from jetloom.streaming.ingest import process_new_files


def collections(spark, sf_dir):
    p = fixture.particles(spark, sf_dir)
    return fixture.tracked(p), queries._generated(p), fixture.vertices(spark, sf_dir), queries._tau_rows(p)


def test_ntuple_rows_obey_the_filters(spark, sf_dir):
    p, gen, v, t = collections(spark, sf_dir)
    background = pipelines.jet_ntuple(p, gen, v, t, pipelines.NtupleConfig(signal=False, event_lists=True, daughters=True))
    rows = background.collect()
    assert rows and all(r.gen_jet_tau_decaymode == -1 and not {11, 13} & {*r.reco_cand_pdgs} and {*r.reco_cand_pdgs} <= {22, 130, 211, 15, 16} for r in rows)
    assert all(len(r.event_reco_cand_dz) >= len(r.reco_cand_dz) == len(r.reco_cand_p4s) and r.gen_jet_tau_vis_daughter_pdgs == [] for r in rows)
    none = [(z, s) for r in rows for q, z, s in zip(r.reco_cand_charges, r.reco_cand_dxy, r.reco_cand_signed_dxy) if q == 0]
    assert none and set(none) == {(-1000.0, -1000.0)}
    for prefix in ("reco_cand_", "event_reco_cand_"):  # every variable and signed form of the record
        assert {f"{prefix}{x}" for x in [*lifetime.VARIABLES, *[f"signed_{s}" for s in lifetime.SIGNED], "p4s", "pdgs", "charges"]} <= {*background.columns}
    assert len(lifetime.VARIABLES) == 28 and {f"gen_jet_tau_{c}" for c in (*taus.PROPERTIES, *taus.DAUGHTERS)} <= {*background.columns}
    signal = pipelines.jet_ntuple(p, gen, v, t).collect()
    assert signal and all(r.gen_jet_tau_decaymode not in (-1, 16) and r.gen_jet_tau_vis_energy > 0 for r in signal)
    assert "reco_cand_dxy" not in pipelines.jet_ntuple(p, gen, v, t, pipelines.NtupleConfig(signal=False, lifetime=False)).columns


def plain_records(p, gen, taus_, radius=0.4, cut=0.4):
    """(event, jet) -> (gen energy, decay mode or None, constituents) of matched jets, by loops."""
    by = lambda rows: {e: sorted((r for r in rows if r.event_id == e), key=lambda r: r[1]) for e in {r.event_id for r in rows}}
    near = lambda a, many: min(((math.hypot(a[0] - b[0], math.remainder(a[1] - b[1], 2 * math.pi)), k) for k, b in enumerate(many)), default=(9, None))
    where = lambda v: (math.asinh(v[3] / math.hypot(v[1], v[2])), math.atan2(v[2], v[1]))
    gens, events, ts, out = by(gen), by(p), by(taus_), {}
    for e, rows in events.items():
        mine = gens.get(e, [])
        vec = lambda rs: np.array([[r.energy, r.px, r.py, r.pz] for r in rs])
        right = [(v, own) for v, own in plain_clustering.genkt_jets(vec(mine), radius) if not {13, 15} & {abs(mine[i].pdg) for i in own}] if mine else []
        places = [where(v) for v, _ in right]
        tau_of = {}
        for t in ts.get(e, []):
            dr, k = near((t.eta, t.phi), places) if t.vis_energy else (9, None)
            if dr < cut:
                tau_of[k] = t.decaymode
        for n, (v, own) in enumerate(plain_clustering.genkt_jets(vec(rows), radius)):
            dr, k = near(where(v), places)
            if dr < cut:
                out[e, n] = (right[k][0][0], tau_of.get(k), [rows[i].pidx for i in own], v[0])
    return out


def test_records_equal_plain_loops(spark, sf_dir):
    p, gen, v, t = collections(spark, sf_dir)
    few = lambda df: df.where("event_id % 3 = 0")
    want = plain_records(few(p).collect(), few(gen).collect(), taus.properties(few(t)).collect())
    codes = {(r.event_id, r.pidx): r.pdg for r in few(p).collect()}
    hadronic = lambda e, own: not {11, 13} & {abs(codes[e, i]) for i in own}
    for signal in (True, False):
        got = pipelines.jet_ntuple(few(p), few(gen), v, few(t), pipelines.NtupleConfig(signal=signal)).collect()
        keep = {k: x for k, x in want.items() if hadronic(k[0], x[2]) and (not signal or x[1] not in (None, 16))}
        assert {(r.event_id, r.jet_id) for r in got} == set(keep)
        for r in got:
            gen_e, mode, own, e = keep[r.event_id, r.jet_id]
            assert r.gen_jet_p4.energy == pytest.approx(gen_e) and r.reco_jet_p4.energy == pytest.approx(e) and len(r.reco_cand_dz) == len(own)
            assert not signal or r.gen_jet_tau_decaymode == mode


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_flows_shuffle_little(spark, sf_dir):
    events = fixture.native_events(spark, sf_dir)
    path = spark.conf.get("spark.checkpoint.dir") + "/native"
    events.write.mode("overwrite").parquet(path)
    native = spark.read.parquet(path)
    made = pipelines.ntuple_of_events(native, pipelines.NtupleConfig(event_lists=True))
    assert exchanges(made) <= 8 and str(made._jdf.queryExecution().executedPlan()).count("MapInArrow") <= 2


def test_native_events_to_tensors(spark, sf_dir, tmp_path):
    source, out = str(tmp_path / "events"), str(tmp_path / "out")
    fixture.native_events(spark, sf_dir).where("event_id % 2 = 0").write.parquet(source)
    paths = pipelines.run_simulation(spark, source, source, out)
    records = readers.load_all(spark, paths["samples"])
    assert {*sampling.MERGED, "cls_weight", "split", "sample"} <= {*records.columns}
    assert records.schema["gen_jet_tau_p4"].dataType.names == ["rho", "phi", "eta", "t"]
    n = {(r["sample"], r["split"]): r["count"] for r in records.groupBy("sample", "split").count().collect()}
    for s in ("signal", "background"):
        assert n[s, "train"] == int((n[s, "train"] + n[s, "test"]) * 0.9)
    tensors_ = spark.read.parquet(paths["tensors"])
    assert tensors_.count() == records.count()
    for r in tensors_.collect():
        assert len(r.features) == len(r.kinematics) == len(r.mask) == 20 and {len(x) for x in r.features} == {17} and {len(x) for x in r.kinematics} == {4}
        assert len(r.targets) == 5 and sum(r.decay_mode) == 1 and r.is_tau == (r["sample"] == "signal") and 0 <= r.weight <= 1
    loaded = readers.load_weights(spark, paths["weights"])
    assert loaded.columns == ["theta_bin", "p_bin", "signal_weight", "background_weight"] and loaded.count() <= 40 * 52


def test_flat_branches_become_the_same_events(spark, sf_dir):
    e = fixture.native_events(spark, sf_dir)
    flat = {"event_id": F.col("event_id")}
    for name, prefix in readers.BRANCHES.items():
        for f in e.schema[name].dataType.elementType:
            inner = f.dataType.names if f.dataType.typeName() == "struct" else [None]
            for g in inner:
                source = "covMatrix.values[21]" if f.name == "cov" else f.name + (f".{g}" if g else "")
                flat[prefix + source] = F.col(f"{name}.{f.name}" + (f".{g}" if g else ""))
    flat |= {b: F.col(c) for c, b in readers.INDEX_BRANCHES.items()}
    wide = e.select(*[c.alias(n) for n, c in flat.items()])
    again = readers.from_branches(wide)
    assert again.dtypes == e.dtypes
    for f in (events_.reco_particles, events_.mc_particles, events_.vertices):
        assert sorted(map(repr, f(again).collect())) == sorted(map(repr, f(e).collect()))
    assert readers.from_branches(wide.drop("MCParticles.PDG")).select(F.max(F.get("mc.PDG", F.lit(0)))).first()[0] is None


def test_links_that_lead_nowhere_are_no_track(spark):
    state = "named_struct('location',0,'D0',float(1),'phi',float(0),'omega',float(0),'Z0',float(0),'tanLambda',float(0),'time',float(0),'referencePoint',named_struct('x',0D,'y',0D,'z',0D),'cov',array_repeat(float(1),21))"
    links = [(0, 1), (0, 0), (1, 2), (2, 3), (9, 10)]  # the first track; none; link -1; a track without states; beyond the list
    reco = ",".join(f"named_struct('PDG',211,'energy',1D,'momentum',named_struct('x',1D,'y',0D,'z',0D),'charge',float(1),'mass',0D,'tracks_begin',{a},'tracks_end',{b})" for a, b in links)
    e = spark.sql(f"SELECT 1L AS event_id, array({reco}) AS reco, array(0, -1, 5) AS idx_track, array_repeat({state}, 4) AS track_states, array(named_struct('x',0D,'y',0D,'z',0D)) AS pv")
    rows = events_.reco_particles(e)
    assert [r.d0 for r in rows.orderBy("pidx").collect()] == [1.0, None, None, None, None]
    life = lifetime.lifetime(rows, events_.vertices(e)).orderBy("pidx").collect()
    assert [r.dxy == -1000.0 for r in life] == [False] + 4 * [True] and life[1].tanl == life[1].pvx == -1000.0


def test_archival_records(spark, sf_dir):
    e, particles, v = queries._archival(spark, sf_dir)
    rows = pipelines.archival_candidates(particles, v)
    assert {c for c in pipelines.PART} <= {*rows.columns}
    without = {(r.event_id, r.pidx) for r in fixture.particles(spark, sf_dir).where("not has_track").collect()}
    assert {(r.event_id, r.pidx) for r in rows.where("d0val = -999.9 and dzerr = -999.9").collect()} == without
    for jets in (pipelines.archival_jets(particles, v), pipelines.stored_archival_jets(particles, events_.stored_jets(e), v, good_only=False)):
        got = jets.collect()
        assert got and {f"part_{c}" for c in (*pipelines.RELATIVE, *pipelines.PART)} <= {*jets.columns}
        for r in got:
            assert len(r.part_pt) == max(1, r.jet_nparticles) and (r.jet_nparticles or r.part_pt == [-999.9])
            if r.jet_nparticles:
                m2 = sum(r.part_energy) ** 2 - sum(r.part_px) ** 2 - sum(r.part_py) ** 2 - sum(r.part_pz) ** 2
                assert r.jet_mass_from_p4s == pytest.approx(math.sqrt(max(0, m2)), abs=1e-3) and max(r.part_deltaR) >= 0


def test_both_matrices_are_the_two_weight_matrices(spark, sf_dir):
    p = fixture.particles(spark, sf_dir)
    s, b = weights.matrix(p.where("is_signal")), weights.matrix(p.where("not is_signal"))
    both = {(r.theta_bin, r.p_bin): r for r in weights.both_matrices(p).collect()}
    for name, one in (("signal_weight", weights.weight_matrix(s, b)), ("background_weight", weights.weight_matrix(b, s))):
        for r in one.collect():
            assert both[r.theta_bin, r.p_bin][name] == pytest.approx(r.weight)


def test_archival_and_beam_filters(spark):
    df = spark.createDataFrame([(1.0, 0.5, [1.0]), (0.0, 0.5, [1.0]), (1.0, float("inf"), [1.0]), (1.0, 0.5, [1.0, -999.9]), (1.0, 0.5, [0.0]), (1.0, 0.5, [])], "pt double, eta double, pts array<double>")
    assert [r[0] for r in df.select(filters.good_stored_jet("pt", "eta", "pts")).collect()] == [True, False, False, False, False, True]
    assert [r[0] for r in df.select(filters.within_beam(F.col("pt") * 91.2, F.transform("pts", lambda x: x * 45.7))).collect()] == [False, False, False, False, True, True]


@pytest.mark.parametrize("name", ["jet_ntuple", "native_ntuple", "stored_archival_jets", "archival_event_records", "archival_events"])
def test_flows_give_rows(spark, sf_dir, name):
    assert queries.QUERIES[name](spark, sf_dir).count() > 0


def test_nested_events_keep_empty_ones(spark, sf_dir):
    e = fixture.nested_events(spark, sf_dir)
    assert e.count() == fixture.vertices(spark, sf_dir).count() and e.where(F.size("reco") == 0).count() > 0
    assert e.select(F.sum(F.size("reco"))).first()[0] == fixture.particles(spark, sf_dir).count()


def test_paths_and_loads(spark, tmp_path):
    for i in range(3):
        spark.range(i, i + 2).coalesce(1).write.parquet(str(tmp_path / f"f{i}.parquet"))
    where = str(tmp_path)
    assert [p.rsplit("/", 1)[1] for p in readers.all_paths(spark, where)] == [f"f{i}.parquet" for i in range(3)]
    assert len(readers.all_paths(spark, where, 2)) == 2 and len(readers.all_paths(spark, f"{where}/f[01]*")) >= 2
    assert readers.all_paths(spark, ["b", "a"]) == ["a", "b"]
    with pytest.raises(ValueError):
        readers.all_paths(spark, f"{where}/none*")
    with pytest.raises(ValueError):
        readers.load_all(spark, [], 0)
    (tmp_path / "list.txt").write_text(f"{where}/f2.parquet\n\n{where}/f1.parquet\n")
    assert [p.rsplit("/", 1)[1] for p in readers.all_paths(spark, f"{where}/list.txt")] == ["f1.parquet", "f2.parquet"]
    (tmp_path / "list.txt").unlink()
    with pytest.raises(ValueError):
        readers.load_parquet(spark, f"{where}/f2.parquet", max_rows=1)
    assert readers.load_all(spark, where, columns=["id"]).count() == 6
    assert [r.id for r in readers.load_parquet(spark, f"{where}/f2.parquet", ["id"], 1, ["id"]).collect()] == [2]
    assert readers.file_sizes(readers.load_all(spark, where)).count() >= 3
    assert readers.modern_names(spark.range(1).withColumnRenamed("id", "reco_cand_pdg")).columns == ["reco_cand_pdgs"]


def test_event_schema_reads_what_it_declares(spark, tmp_path):
    empty = spark.createDataFrame([], readers.EVENT_SCHEMA)
    empty.write.parquet(str(tmp_path / "e.parquet"))
    df = readers.LOADERS["podio"](spark, str(tmp_path / "e.parquet"))
    assert df.count() == 0 and df.schema["reco"].dataType.elementType["energy"].dataType.typeName() == "double"


def test_samples(spark, tmp_path):
    spark.createDataFrame([(1, -1), (2, 0)], "j int, gen_jet_tau_decaymode int").write.parquet(str(tmp_path / "s"))
    spark.createDataFrame([(3, -1)], "j int, gen_jet_tau_decaymode int").write.parquet(str(tmp_path / "b"))
    out = readers.load_samples(spark, [str(tmp_path / "s")], [str(tmp_path / "b")])
    assert sorted((r.j, r.is_signal) for r in out.collect()) == [(2, True), (3, False)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "train"), (2, "b", "test")], "x int, sample string, split string")
    path = sinks.write_split(df, str(tmp_path / "out"))
    part = spark.read.parquet(path).where("sample = 'a'")
    assert part.count() == 1 and "PartitionFilters: [isnotnull(sample" in part._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        sinks.write_weighted(df, path, path + "/")


def test_new_files_are_taken_once(spark, tmp_path):
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    run = lambda: process_new_files(spark, source, "id long", lambda d: d.withColumn("y", F.col("id") * 2), target, state)
    spark.range(3).coalesce(1).write.mode("append").parquet(source)
    assert run() == 1 and run() == 0
    spark.range(3, 5).coalesce(1).write.mode("append").parquet(source)
    assert run() == 1
    assert sorted((r.id, r.y) for r in spark.read.parquet(target).collect()) == [(i, 2 * i) for i in range(5)]


def test_native_events_are_widened_after_their_last_exchange(spark, sf_dir):
    """What is shuffled and sorted for native events are plain numbers; track states and covariances are made afterwards."""
    plan = fixture.native_events(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "trackstates" in line.lower().replace("_", "") or "covmatrix" in line.lower()]
    assert wide and not any(x in line for line in wide for x in ("Exchange", "Sort ", "SortMergeJoin", "Aggregate"))


def test_stored_files_are_written_in_one_pass(spark, sf_dir, tmp_path):
    files = queries._stored_files(spark, sf_dir, f"{tmp_path}/in")
    assert isinstance(files, list) and len(files) == 5
    for k, path in enumerate(files):
        assert [r.rest for r in spark.read.parquet(path).select((F.col("event_id") % 5).alias("rest")).distinct().collect()] == [k]
    plain = lambda df: df.select("event_id", F.size("reco").alias("n"), F.get("reco.energy", F.lit(0)).alias("first")).orderBy("event_id").collect()
    assert plain(spark.read.parquet(*files)) == plain(fixture.native_events(spark, sf_dir))


def test_signal_records_look_only_at_events_with_taus(spark, sf_dir):
    e = fixture.native_events(spark, sf_dir)
    mc, config = events_.mc_particles(e), pipelines.NtupleConfig(lifetime=False)
    made = pipelines.ntuple_of_events(e, config)
    assert "exists(" in made._jdf.queryExecution().optimizedPlan().toString()
    whole = pipelines.jet_ntuple(events_.reco_particles(e), mc.where(filters.stable_visible()), events_.vertices(e), taus.taus_with_daughters(mc), config)
    plain = lambda df: sorted(tuple(r) for r in df.select("event_id", "jet_id", "gen_jet_tau_decaymode", "reco_cand_pdgs").collect())
    assert plain(made) and plain(made) == plain(whole)


def exchanges_of(spark, df) -> int:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name, most", [("archival_events", 2), ("tau_to_jet_left_fill", 3)])
def test_rows_are_found_where_their_event_is(spark, sf_dir, name, most):
    assert exchanges_of(spark, queries.QUERIES[name](spark, sf_dir)) <= most
