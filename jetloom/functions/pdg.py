"""Particle codes, candidate classes and tau decay modes as Column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .p4 import col

# Public particle-numbering codes with their charges (in units of e) for positive codes.
HADRON_CHARGES = {
    111: 0, 113: 0, 130: 0, 211: 1, 213: 1, 221: 0, 223: 0, 310: 0, 311: 0, 313: 0, 321: 1, 323: 1, 331: 0, 333: 0,
    411: 1, 421: 0, 431: 1, 511: 0, 521: 1, 531: 0, 2112: 0, 2212: 1, 3112: -1, 3122: 0, 3222: 1, 3312: -1, 3322: 0,
}
LEPTON_CHARGES = {11: -1, 12: 0, 13: -1, 14: 0, 15: -1, 16: 0, 22: 0}
NEUTRINOS = (12, 14, 16)
#: Species that a decay mode may be made of.
COMMON = (11, 12, 13, 14, 16, 130, 211)


def _lookup(table: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())]), key)


def is_hadron(pdg) -> Column:
    return F.abs(col(pdg)).isin(*HADRON_CHARGES)


def table_charge(pdg) -> Column:
    """Charge by the numbering scheme; NULL for codes that the table does not have (reported, not guessed)."""
    charge = _lookup(HADRON_CHARGES | LEPTON_CHARGES, F.abs(col(pdg)))
    return F.when(col(pdg) < 0, -charge).otherwise(charge)


def candidate_id(pdg, charge=None) -> Column:
    """211 or 130 for charged and neutral hadrons, |pdg| else. ``charge``: a measured one; else the table's."""
    q = col(charge) if charge is not None else table_charge(pdg)
    return F.when(is_hadron(pdg), F.when(q != 0, 211).otherwise(130)).otherwise(F.abs(col(pdg))).cast("int")


def visible(pdg) -> Column:
    return ~F.abs(col(pdg)).isin(*NEUTRINOS)


def decay_mode(charged, neutral, leptons, uncommon) -> Column:
    """Mode 0-16 from counts: prongs (211), neutral hadrons (130), charged leptons, species outside ``COMMON``."""
    charged, neutral = col(charged), col(neutral)
    return (
        F.when(col(uncommon) > 0, 15)
        .when(charged.between(1, 3), 5 * (charged - 1) + F.least(neutral, F.lit(4)))
        .when(col(leptons) > 0, 16)
        .otherwise(15)
        .cast("int")
    )


def decay_mode_of(ids) -> Column:
    """The same from an array of candidate ids."""
    n = lambda *codes: F.size(F.filter(col(ids), lambda x: F.abs(x).isin(*codes)))
    uncommon = F.size(F.filter(col(ids), lambda x: ~F.abs(x).isin(*COMMON)))
    return decay_mode(n(211), n(130), n(11, 13), uncommon)


def reduced_mode(mode) -> Column:
    """Analysis reduction: 2-4 to 2, 5 and 10 to 10, 6-9 and 11-14 to 11, no tau (-1) to 15."""
    m = col(mode)
    return (
        F.when(m == -1, 15).when(m.between(2, 4), 2).when(m.isin(5, 10), 10).when(m.between(6, 9) | m.between(11, 14), 11).otherwise(m)
    ).cast("int")


def class_index(mode) -> Column:
    """Training class 0-5 of a reduced mode."""
    return _lookup({0: 0, 1: 1, 2: 2, 10: 3, 11: 4, 15: 5, 16: 5}, col(mode)).cast("int")


def plot_mode(mode) -> Column:
    """Validation grouping: 0, 1, 2-4, 10, 11-14 to 0..4, 5-9 and 15 to 5 (other), the rest -1."""
    m = col(mode)
    return (
        F.when(m.isin(0, 1), m).when(m.between(2, 4), 2).when(m == 10, 3).when(m.between(11, 14), 4).when(m.between(5, 9) | (m == 15), 5).otherwise(-1)
    ).cast("int")


def mode_name(mode) -> Column:
    """OneProng0PiZero and so on, by rule."""
    m = col(mode)
    prongs = F.element_at(F.array(F.lit("One"), F.lit("Two"), F.lit("Three")), (F.floor(m / 5) + 1).cast("int"))
    pions = F.when(m % 5 == 4, "N").otherwise((m % 5).cast("string"))
    return (
        F.when(m == 15, "RareDecayMode").when(m == 16, "LeptonicDecay")
        .when(m.between(0, 14), F.concat(prongs, F.lit("Prong"), pions, F.lit("PiZero")))
    )


#: Names of species in plots, by absolute code.
PARTICLE_NAMES = {11: "electron", 13: "muon", 15: "tau", 22: "photon", 111: "neutral pion", 130: "neutral hadron", 211: "charged hadron", 321: "charged kaon"}


def particle_name(pdg) -> Column:
    """The species' name; neutrinos are invisible, the rest other."""
    name = _lookup(PARTICLE_NAMES, F.abs(col(pdg)))
    return F.when(visible(pdg), F.coalesce(name, F.lit("other"))).otherwise("invisible")


def signature(pdgs) -> Column:
    """Canonical species list: sorted absolute codes."""
    return F.array_sort(F.transform(col(pdgs), F.abs))
