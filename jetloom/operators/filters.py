"""Particle, jet and event selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jetloom.functions.p4 import col, finite
from jetloom.functions.pdg import visible

#: Beam limits in GeV and the padding value (fixed values).
MAX_PARTICLE_ENERGY, MAX_JET_ENERGY, PAD = 45.6, 91.2, -999.9


def stable_visible(status="status", pdg="pdg") -> Column:
    return (col(status) == 1) & visible(pdg)


def is_tau(status="status", pdg="pdg") -> Column:
    return (F.abs(col(pdg)) == 15) & (col(status) == 2)


def has_species(pdgs, *codes: int) -> Column:
    return F.exists(col(pdgs), lambda x: F.abs(x).isin(*codes))


def lepton_free_generated(pdgs) -> Column:
    """Generated-jet veto: no tau or muon among the constituents (electrons are not tested)."""
    return ~has_species(pdgs, 13, 15)


def hadronic(pdgs) -> Column:
    """Reconstructed-jet veto: no electron or muon candidate."""
    return ~has_species(pdgs, 11, 13)


def good_mode(mode, signal: bool) -> Column:
    m = col(mode)
    return (m != 16) & (m != -1) if signal else m != 16


def bad_particle(pt, energy) -> Column:
    pt, energy = col(pt), col(energy)
    return (pt <= 0) | (energy >= MAX_PARTICLE_ENERGY) | (pt == PAD) | ~finite(pt) | ~finite(energy)


def good_archival_jet(pt, eta, energy, particles) -> Column:
    """Positive pt, finite eta, energy within the beam's, and no bad particle in ``particles`` (array of struct pt, energy)."""
    return (col(pt) > 0) & finite(eta) & (col(energy) <= MAX_JET_ENERGY) & ~F.exists(col(particles), lambda x: bad_particle(x.pt, x.energy))


def bad_event_jet(pt, eta, energy) -> Column:
    """The event filter's jet test: pt below zero, unlike the jet filter, which also drops zero."""
    return (col(pt) < 0) | ~finite(eta) | (col(energy) > MAX_JET_ENERGY)


def good_events(particles: DataFrame, jets: DataFrame) -> DataFrame:
    """event_id of events with a jet and without bad particles or bad jets."""
    by_particle = particles.groupBy("event_id").agg(F.bool_or(bad_particle("pt", "energy")).alias("bad"))
    by_jet = jets.groupBy("event_id").agg(F.bool_or(bad_event_jet("pt", "eta", "energy")).alias("bad_jet"))
    both = by_jet.join(by_particle, "event_id", "left")
    return both.where(~F.col("bad_jet") & ~F.coalesce("bad", F.lit(False))).select("event_id")


def good_stored_jet(pt, eta, particle_pts) -> Column:
    """The test of stored jets: positive pt, finite eta, and no particle whose pt is missing, not positive or not finite (energies are not looked at)."""
    return (col(pt) > 0) & finite(eta) & ~F.exists(col(particle_pts), lambda x: (x <= 0) | (x == PAD) | ~finite(x))


def within_beam(jet_energy, particle_pts) -> Column:
    """The overview's test: jets within the beam's energy whose particles all are."""
    return (col(jet_energy) <= MAX_JET_ENERGY) & ~F.exists(col(particle_pts), lambda x: x > MAX_PARTICLE_ENERGY)


def with_stored_jets(events: DataFrame, jets: str = "jets") -> DataFrame:
    return events.where(F.size(jets) > 0)
