"""Joins within events: nearest neighbour in angle, links, gathers, fills."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jetloom.functions import p4
from jetloom.functions.p4 import col

from .clustering import _groups, _offsets, _runs

#: Pairs that are worked on at once, and what a distance may be off by rounding.
PAIRS, ROUNDING = 1 << 21, 1e-9


def _exact_dr(d_eta: float, d_phi: float) -> float:
    """The distance by the C library, one operation after another, as in SQL."""
    return math.sqrt(math.pow(d_eta, 2.0) + math.pow(math.atan2(math.sin(d_phi), math.cos(d_phi)), 2.0))


def _direction(px: float, py: float, pz: float) -> tuple[float, float]:
    """eta and phi of a momentum by the C library, as in SQL; without transverse momentum eta is infinite."""
    pt = math.sqrt(px * px + py * py)
    return math.asinh(pz / pt) if pt > 0 else math.copysign(math.inf, pz) if pz else 0.0, math.atan2(py, px)


def _directions_of(momenta: np.ndarray) -> np.ndarray:
    """eta and phi of momenta but for rounding."""
    pt = np.hypot(momenta[:, 0], momenta[:, 1])
    flat = np.where(momenta[:, 2] == 0, 0.0, np.copysign(np.inf, momenta[:, 2]))
    return np.stack([np.where(pt > 0, np.arcsinh(momenta[:, 2] / np.where(pt > 0, pt, 1.0)), flat), np.arctan2(momenta[:, 1], momenta[:, 0])], axis=-1)


def nearest_places(left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray, max_dr: float, inclusive: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Place (-1: none near enough) and distance of each left object's nearest right one of the same event; rows are (eta, phi) or (px, py, pz), events one after another.

    Distances that rounding could order either way, or put on either side of ``max_dr``, are made again by ``_exact_dr``, from momenta
    by ``_direction`` before. Ties go to the smaller place; an object without a direction takes no part.
    """
    sides = (left, right)
    left, right = (_directions_of(x) if x.shape[1] == 3 else x for x in sides)
    exact = lambda side, at: _direction(*sides[side][at].tolist()) if sides[side].shape[1] == 3 else sides[side][at].tolist()
    counts, starts = np.repeat(n_right, n_left), np.repeat(np.cumsum(n_right) - n_right, n_left)
    at, best = np.full(len(left), -1), np.full(len(left), np.inf)
    some = np.flatnonzero(counts > 0)
    cuts = np.flatnonzero(np.diff(np.cumsum(counts[some]) // PAIRS)) + 1
    for own in np.split(some, cuts) if len(some) else ():
        n = counts[own]
        first, of, to = np.cumsum(n) - n, np.repeat(own, n), _runs(starts[own], n)
        with np.errstate(invalid="ignore"):
            d_eta, d_phi = left[of, 0] - right[to, 0], left[of, 1] - right[to, 1]
        turn = np.arctan2(np.sin(d_phi), np.cos(d_phi))
        dr = np.sqrt(d_eta * d_eta + turn * turn)
        dr[np.isnan(dr)] = np.inf
        low = np.repeat(np.minimum.reduceat(dr, first), n)
        near = np.isfinite(dr) & (dr <= low + ROUNDING)
        unsure = np.repeat(np.add.reduceat(near.astype(int), first) > 1, n) | (np.abs(low - max_dr) <= ROUNDING)
        for k in np.flatnonzero(near & unsure):
            (eta, phi), (other_eta, other_phi) = exact(0, of[k]), exact(1, to[k])
            dr[k] = _exact_dr(eta - other_eta, phi - other_phi)
        low = np.minimum.reduceat(dr, first)
        place = to - np.repeat(starts[own], n)
        at[own] = np.minimum.reduceat(np.where(dr == np.repeat(low, n), place, np.iinfo(int).max), first)
        best[own] = low
    at[~((best <= max_dr) if inclusive else (best < max_dr))] = -1
    return at, best


#: What a list's objects are placed by.
ANGLES, MOMENTA = ("eta", "phi"), ("px", "py", "pz")


def nearest_in_lists(left: str, right: str, max_dr: float, inclusive: bool = False, by: tuple[tuple[str, ...], tuple[str, ...]] = (ANGLES, ANGLES)) -> Column:
    """array<struct<at, dr>>: for each struct of the list ``left`` the place of the nearest one in ``right``, -1 if none is near enough.

    ``by``: the fields of each list that give directions, ``ANGLES`` or ``MOMENTA``. Only these lists leave the row.
    """

    def run(*fields: pa.Array) -> pa.Array:
        a, b = _groups(*fields[: len(by[0])]), _groups(*fields[len(by[0]) :])
        at, dr = nearest_places(a.values, a.sizes, b.values, b.sizes, max_dr, inclusive)
        return pa.ListArray.from_arrays(_offsets(a.sizes), pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(dr)], ["at", "dr"]))

    return F.arrow_udf(run, "array<struct<at: int, dr: double>>")(*[F.col(f"{x}.{c}") for x, names in zip((left, right), by, strict=True) for c in names])


def directions(px, py, pz, pt) -> Column:
    """struct<eta, phi> of a momentum and its transverse part by the C library, for those that ties hang on."""

    def run(*columns: pa.Array) -> pa.Array:
        rows = zip(*[c.to_pylist() for c in columns], strict=True)
        found = [(None, None) if None in r else (math.asinh(r[2] / r[3]) if r[3] > 0 else _direction(*r[:3])[0], math.atan2(r[1], r[0])) for r in rows]
        return pa.StructArray.from_arrays([pa.array([f[k] for f in found], pa.float64()) for k in (0, 1)], ["eta", "phi"])

    return F.arrow_udf(run, "struct<eta: double, phi: double>")(*[col(c) for c in (px, py, pz, pt)])


def _directions(objects: DataFrame, own_id: str, name: str) -> DataFrame:
    return objects.groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct(F.col(own_id).alias("id"), F.col("eta").cast("double").alias("eta"), F.col("phi").cast("double").alias("phi")))).alias(name))


def nearest(left: DataFrame, right: DataFrame, max_dr: float = 0.4, left_id: str = "pidx", right_id: str = "pidx", inclusive: bool = False, energy: str | None = None) -> DataFrame:
    """event_id, left_id, right_id, dr: for each left object the nearest right one of its event, if near enough.

    Ties go to the smaller right id; several left objects may share a right one;
    objects without energy take no part. An event's objects are gathered in one row and matched
    there: one exchange for each collection, and no row for each pair.
    """
    a, b = left, right
    if energy:
        a, b = a.where(F.col(energy) != 0), b.where(F.col(energy) != 0)
    both = _directions(a, left_id, "l").join(_directions(b, right_id, "r"), "event_id")
    found = both.withColumn("found", nearest_in_lists("l", "r", max_dr, inclusive))
    rows = found.select("event_id", "r", F.inline(F.arrays_zip(F.col("l.id").alias("left_id"), F.col("found.at").alias("at"), F.col("found.dr").alias("dr")))).where("at >= 0")
    return rows.select("event_id", "left_id", F.get("r.id", F.col("at")).alias("right_id"), "dr")


def paired(rows: DataFrame, left: Column, right: Column, max_dr: float = 0.4, inclusive: bool = False) -> DataFrame:
    """event_id, left, right, dr: ``nearest`` for two collections that are made of the same rows, with whatever else the two structs hold.

    ``left`` and ``right`` are structs of a row that begin with the object's number and have eta and phi, NULL where the row gives no such object. Both lists
    come from one aggregation, so the rows are shuffled once.
    """
    both = rows.groupBy("event_id").agg(F.array_sort(F.collect_list(left)).alias("l"), F.array_sort(F.collect_list(right)).alias("r"))
    found = both.where(F.size("r") > 0).withColumn("found", nearest_in_lists("l", "r", max_dr, inclusive))
    each = found.select("event_id", "r", F.inline(F.arrays_zip(F.col("l").alias("left"), F.col("found.at").alias("at"), F.col("found.dr").alias("dr")))).where("at >= 0")
    return each.select("event_id", "left", F.get("r", F.col("at")).alias("right"), "dr")


def nearest_at(eta, phi, others, max_dr: float = 0.4, inclusive: bool = False, with_energy: bool = True) -> Column:
    """Place in the list ``others`` (structs with eta, phi and, ``with_energy``, energy) of the object nearest to (eta, phi), NULL if none is near enough.

    The same rules as ``nearest``, inside an event's row: no shuffle. Objects without energy count unless ``with_energy``.
    """
    dr = lambda x, i: F.when((x.energy != 0) if with_energy else F.lit(True), F.struct(p4.delta_r(col(eta), col(phi), x.eta, x.phi).alias("dr"), i.alias("at")))
    best = F.array_min(F.filter(F.transform(col(others), dr), lambda x: x.isNotNull()))
    return F.when(best["dr"] <= max_dr if inclusive else best["dr"] < max_dr, best["at"])


def assign(particles: DataFrame, jets: DataFrame, max_dr: float = 0.8) -> DataFrame:
    """event_id, jet_id, n_particles, particle ids in order, for every jet (none: 0): particles go to the nearest jet within ``max_dr``."""
    both = _directions(jets, "jet_id", "r").join(_directions(particles, "pidx", "l"), "event_id", "left")
    found = both.withColumn("at", nearest_in_lists("l", "r", max_dr, inclusive=True)["at"])
    rows = found.select("event_id", "l", "at", F.posexplode("r.id").alias("place", "jet_id"))
    own = F.filter(F.col("l.id"), lambda x, i: F.get(F.col("at"), i) == F.col("place"))
    out = rows.select("event_id", "jet_id", F.coalesce(own, F.array().cast(f"array<{particles.schema['pidx'].dataType.simpleString()}>")).alias("particles"))
    return out.select("event_id", "jet_id", F.size("particles").cast("long").alias("n_particles"), "particles")


def fill_last(jets: DataFrame, found: DataFrame, jet_id: str, order: str, fills: dict) -> DataFrame:
    """Jets with the properties of their match, the one with the largest ``order`` of several; else the fill values."""
    last = found.groupBy("event_id", jet_id).agg(F.max_by(F.struct(*fills), order).alias("m"))
    joined = jets.join(last, ["event_id", jet_id], "left")
    return joined.select(*jets.columns, *[F.coalesce(F.col(f"m.{c}"), v if isinstance(v, Column) else F.lit(v)).alias(c) for c, v in fills.items()])


def link_range(begin, end, links) -> Column:
    """Links [begin, end) of an index array; empty when the range is."""
    n = F.greatest(col(end) - col(begin), F.lit(0))
    return F.slice(col(links), col(begin) + 1, n)


def first_link(begin, end, links, n_states, states_per_track: int = 4) -> Column:
    """Index of the track state of a particle's first track, NULL if it has none that exists."""
    link = F.get(col(links), col(begin))
    at = link * states_per_track
    ok = (col(begin) != col(end)) & (link >= 0) & (at < col(n_states))
    return F.when(ok, at)


def gather(values, indices) -> Column:
    """values[i] for each i; NULL beyond the ends."""
    return F.transform(col(indices), lambda i: F.get(col(values), i))


def replicate(jets: DataFrame, event_lists: DataFrame) -> DataFrame:
    """Each jet with its event's lists. Grows as jets times particles, so it is a choice of the caller."""
    return jets.join(event_lists, "event_id")
