"""Event shapes, jet sums and particle features relative to jets."""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jetloom.functions import p4
from jetloom.functions.p4 import col

#: Archival species flags (fixed values): charged hadron, electron, muon, photon, neutral hadron.
SPECIES = {"isChargedHadron": 0, "isElectron": 1, "isMuon": 2, "isPhoton": 4, "isNeutralHadron": 5}


def species_flags(code) -> dict[str, Column]:
    return {name: F.coalesce((col(code) == k).cast("int"), F.lit(0)) for name, k in SPECIES.items()}


def eigenvalues(xx, yy, zz, xy, xz, yz) -> list[Column]:
    """Ascending eigenvalues of a symmetric 3 x 3 matrix in closed form (by the cosine of a third of an angle)."""
    a = [col(x) for x in (xx, yy, zz)]
    b = [col(x) for x in (xy, xz, yz)]
    off = b[0] * b[0] + b[1] * b[1] + b[2] * b[2]
    mean = (a[0] + a[1] + a[2]) / 3.0
    d = [x - mean for x in a]
    size = F.sqrt((d[0] * d[0] + d[1] * d[1] + d[2] * d[2] + 2.0 * off) / 6.0)
    det = d[0] * (d[1] * d[2] - b[2] * b[2]) - b[0] * (b[0] * d[2] - b[2] * b[1]) + b[1] * (b[0] * b[2] - d[1] * b[1])
    cube = size * size * size
    r = F.when(cube == 0, 0.0).otherwise(det / F.when(cube == 0, 1.0).otherwise(2.0 * cube))
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))) / 3.0
    top = mean + 2.0 * size * F.cos(angle)
    low = mean + 2.0 * size * F.cos(angle + F.lit(2.0 * math.pi / 3.0))
    return [low, 3.0 * mean - top - low, top]


TENSOR = ("xx", "yy", "zz", "xy", "xz", "yz")


def tensor_sums() -> list[Column]:
    """Aggregates of an event's particles: the momentum tensor's entries txx ... tyz, not normalised."""
    return [F.sum(F.col("p" + a) * F.col("p" + b)).alias("t" + a + b) for a, b in TENSOR]


def normalised_tensor() -> dict[str, Column]:
    total = F.col("txx") + F.col("tyy") + F.col("tzz")
    return {"t" + k: F.try_divide(F.col("t" + k), total) for k in TENSOR}


def momentum_tensor(particles: DataFrame) -> DataFrame:
    """Per event the normalised momentum tensor's entries, all from one aggregation."""
    per = particles.groupBy("event_id").agg(*tensor_sums())
    return per.select("event_id", *[c.alias(n) for n, c in normalised_tensor().items()])


def shape_columns() -> list[Column]:
    """lambda1 <= lambda2 <= lambda3, sphericity and aplanarity of the normalised tensor."""
    low, mid, top = eigenvalues(*["t" + k for k in TENSOR])
    return [low.alias("lambda1"), mid.alias("lambda2"), top.alias("lambda3"), (1.5 * (low + mid)).alias("sphericity"), (1.5 * low).alias("aplanarity")]


def sphericity(particles: DataFrame) -> DataFrame:
    """event_id, lambda1 <= lambda2 <= lambda3 (of the tensor), sphericity and aplanarity of events with momentum."""
    return momentum_tensor(particles).select("event_id", *shape_columns())


#: Columns of ``event_variables`` -> species flag of archival records (fixed values).
COUNTED = {"n_charged_hadrons": "isChargedHadron", "n_electrons": "isElectron", "n_muons": "isMuon", "n_photons": "isPhoton", "n_neutral_hadrons": "isNeutralHadron"}


def species_of_code(code="pdg") -> dict[str, Column]:
    """The archival species flags by particle code instead."""
    a = F.abs(col(code))
    return {"isChargedHadron": a.isin(211, 321), "isElectron": a == 11, "isMuon": a == 13, "isPhoton": a == 22, "isNeutralHadron": a.isin(130, 111)}


def particle_scalars(particles: DataFrame) -> list[Column]:
    """Aggregates of an event's particles: missing momentum and numbers of each species, by the flags where particles have them, else by their code ``pdg``."""
    flagged = all(c in particles.columns for c in SPECIES)
    is_species = {c: F.col(c) == 1 for c in SPECIES} if flagged else species_of_code()
    met = F.sqrt(F.pow(F.sum("px"), 2.0) + F.pow(F.sum("py"), 2.0)).alias("met")
    return [met, *[F.count(F.when(is_species[flag], 1)).alias(name) for name, flag in COUNTED.items()]]


def event_variables(particles: DataFrame, jets: DataFrame) -> DataFrame:
    """Missing momentum, summed jet pt and numbers of jets and of each species, per event with particles.

    Species go by the flags where particles have them, else by their code ``pdg``.
    """
    per = particles.groupBy("event_id").agg(*particle_scalars(particles))
    by_jet = jets.groupBy("event_id").agg(F.sum("pt").alias("ht"), F.count("*").alias("n_jets"))
    return per.join(by_jet, "event_id", "left").fillna({"ht": 0.0, "n_jets": 0})


def summed_p4(particles: DataFrame, *keys: str) -> DataFrame:
    """keys, px, py, pz, energy, mass and p4 of the sums per group."""
    per = particles.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("px", "py", "pz", "energy")], F.count("*").alias("n"))
    m2 = F.col("energy") * F.col("energy") - F.col("px") * F.col("px") - F.col("py") * F.col("py") - F.col("pz") * F.col("pz")
    return per.withColumns({"mass": F.sqrt(F.greatest(m2, F.lit(0.0))), "p4": p4.from_cartesian("px", "py", "pz", energy="energy")})


def relative(get: Callable[[str], Column], jet: Callable[[str], Column]) -> dict[str, Column]:
    """Ratios and signed and unsigned differences of a particle and its jet, from accessors of pt, eta, phi and energy."""
    return {
        "ptrel": F.try_divide(get("pt"), jet("pt")),
        "erel": F.try_divide(get("energy"), jet("energy")),
        "deta": p4.delta_eta(get("eta"), jet("eta")),
        "dphi": p4.delta_phi(get("phi"), jet("phi")),
        "deltaR": p4.delta_r(get("eta"), get("phi"), jet("eta"), jet("phi")),
        "etarel": get("eta") - jet("eta"),
        "phirel": p4.signed_delta_phi(get("phi"), jet("phi")),
    }


def relative_features(rows: DataFrame) -> DataFrame:
    """Adds them to particles joined to their jets (jet_pt, jet_eta, jet_phi, jet_energy)."""
    return rows.withColumns(relative(F.col, lambda c: F.col(f"jet_{c}")))


def phirel(rows_phi="phi", jet_x="jet_px", jet_y="jet_py", jet_phi="jet_phi") -> Column:
    """Signed azimuth from the jet to the particle. At half a turn the last bit of the jet's azimuth decides the sign; there it is made by the C library, as in SQL."""

    def run(phi: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
        turns = [None if a is None else a - math.atan2(c, b) for a, b, c in zip(phi.to_pylist(), x.to_pylist(), y.to_pylist(), strict=True)]
        return pa.array([None if d is None else math.atan2(math.sin(d), math.cos(d)) for d in turns], pa.float64())

    plain = p4.signed_delta_phi(rows_phi, jet_phi)
    half = F.abs(plain) > math.pi - 1e-9
    again = F.arrow_udf(run, "double")(*[F.when(half, col(c)) for c in (rows_phi, jet_x, jet_y)])
    return F.coalesce(again, plain)
