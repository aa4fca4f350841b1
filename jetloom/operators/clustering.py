"""Sequential recombination and what needs its trees: jets, groomed masses, subjettiness, thrust.

Merging is sequential by nature, so an event's (or jet's) particles are gathered into one row, and a NumPy kernel takes all
rows of an Arrow batch that have equally many particles through the same step at once. Every object knows its nearest later
neighbour, and a merge renews only the rows that it touches: memory grows with the particles of a batch and not with their
pairs, and work with the square of an event's particles in the usual case. Batches are cut at ``BUDGET`` bytes.

Kernels are Arrow functions of the lists that they need; the rest of a record stays where it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import cos, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of the arrays of the rows that are worked on at once.
BUDGET = 64 << 20


def eta_phi(p4: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pseudorapidity and azimuth of four-vectors (E, px, py, pz); 0 without transverse momentum."""
    pt = np.hypot(p4[..., 1], p4[..., 2])
    return np.where(pt > 0, np.arcsinh(p4[..., 3] / np.where(pt > 0, pt, 1.0)), 0.0), np.where(pt > 0, np.arctan2(p4[..., 2], p4[..., 1]), 0.0)


def weight(p4: np.ndarray, power: float = -1.0) -> np.ndarray:
    """E to twice the power; an object without energy counts as 1."""
    e = np.where(p4[..., 0] > 0, p4[..., 0], 1.0)
    return 1.0 / (e * e) if power == -1.0 else e ** (2 * power)


def massless(pt: np.ndarray, eta: np.ndarray, phi: np.ndarray) -> np.ndarray:
    return np.stack([pt * np.cosh(eta), pt * np.cos(phi), pt * np.sin(phi), pt * np.sinh(eta)], axis=-1)


def invariant_mass(p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, p[..., 0] ** 2 - p[..., 1] ** 2 - p[..., 2] ** 2 - p[..., 3] ** 2))


def turned(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The azimuth from b to a, in one turn."""
    d = a - b
    return d - 2 * np.pi * np.rint(d / (2 * np.pi))


@dataclass(frozen=True)
class Metric:
    """``features`` of four-vectors, from which ``pair`` gives the distance of two objects."""

    features: Callable[[np.ndarray], np.ndarray]
    pair: Callable[[np.ndarray, np.ndarray], np.ndarray]


def energy_metric(scale: float = 1.0, power: float = -1.0) -> Metric:
    """The smaller weight of two objects times 1 - cos of their angle, over ``scale``; 0 if one has no momentum.

    The cosine is the dot product over the product of both lengths, in this order of operations, which decides between pairs that are
    equally far but for rounding.
    """

    def features(p4: np.ndarray) -> np.ndarray:
        x, y, z = p4[..., 1], p4[..., 2], p4[..., 3]
        return np.stack([x, y, z, np.sqrt(x * x + y * y + z * z), weight(p4, power)], axis=-1)

    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        dot = a[..., 0] * b[..., 0] + a[..., 1] * b[..., 1] + a[..., 2] * b[..., 2]
        size = a[..., 3] * b[..., 3]
        cos = np.clip(dot / np.where(size > 0, size, 1.0), -1.0, 1.0)
        return np.minimum(a[..., 4], b[..., 4]) * np.where(size > 0, 1.0 - cos, 0.0) / scale

    return Metric(features, pair)


ANGULAR = Metric(lambda p4: np.stack(eta_phi(p4), axis=-1), lambda a, b: np.hypot(a[..., 0] - b[..., 0], turned(a[..., 1], b[..., 1])))


@dataclass(frozen=True)
class History:
    """What was merged in many events of n objects each. Objects n, n + 1, ... are those that step 0, 1, ... made.

    left, right: (event, step), the smaller and the larger of the two merged; right is -1 where left went to the beam. distance:
    of the step. nodes: (event, object) four-vectors.
    """

    left: np.ndarray
    right: np.ndarray
    distance: np.ndarray
    nodes: np.ndarray


def recombined(p4: np.ndarray, metric: Metric, beam: Callable[[np.ndarray], np.ndarray] | None = None) -> History:
    """Smallest distance first, in all events of ``p4`` (event, object, 4) together, until one object is left, or with ``beam`` none.

    Ties go to the smaller pair, a pair before the beam.
    """
    events, n = p4.shape[:2]
    steps = n if beam else n - 1
    size = n + max(steps, 0)
    rows = np.arange(events)
    nodes, f = np.zeros((events, size, 4)), None
    nodes[:, :n] = p4
    first = metric.features(nodes[:, :n])
    f = np.zeros((events, size, first.shape[-1]))
    f[:, :n] = first
    alive = np.zeros((events, size), bool)
    alive[:, :n] = True
    near, far = np.zeros((events, size), np.int32), np.full((events, size), np.inf)  # nearest later object and its distance
    for i in range(n - 1):
        d = metric.pair(f[:, i, None], f[:, i + 1 : n])
        near[:, i] = i + 1 + d.argmin(axis=1)
        far[:, i] = d[rows, near[:, i] - i - 1]
    out = np.full((events, size), np.inf)
    if beam:
        out[:, :n] = beam(nodes[:, :n])
    left, right, distance = np.zeros((events, steps), np.int32), np.full((events, steps), -1, np.int32), np.zeros((events, steps))
    at_once = max(1, BUDGET // (8 * size * 8))
    for step in range(steps):
        new = n + step
        i = far.argmin(axis=1)
        d = far[rows, i]
        j = near[rows, i]
        gone = np.zeros(events, bool)
        if beam:
            k = out.argmin(axis=1)
            gone = out[rows, k] < d
            i = np.where(gone, k, i)
            d = np.where(gone, out[rows, k], d)
        pair = np.flatnonzero(~gone)
        left[:, step], distance[:, step] = i, d
        right[pair, step] = j[pair]
        for e, x in ((rows, i), (pair, j[pair])):
            alive[e, x], far[e, x], out[e, x] = False, np.inf, np.inf
        made = nodes[pair, i[pair]] + nodes[pair, j[pair]]
        nodes[pair, new], alive[pair, new] = made, True
        f[pair, new] = metric.features(made)
        if beam:
            out[pair, new] = beam(made)
        # rows whose neighbour is gone look for another among all later objects; the others only at the new one
        lost = alive & np.isfinite(far) & ((near == i[:, None]) | ((near == j[:, None]) & ~gone[:, None]))
        if len(pair):
            to_new = np.where(alive[pair, :new] & ~lost[pair, :new], metric.pair(f[pair, :new], f[pair, new, None]), np.inf)
            closer = to_new < far[pair, :new]
            e, k = np.nonzero(closer)
            far[pair[e], k], near[pair[e], k] = to_new[e, k], new
        e, k = np.nonzero(lost)
        for at in range(0, len(e), at_once):
            ee, kk = e[at : at + at_once], k[at : at + at_once]
            d = metric.pair(f[ee, kk, None], f[ee, : new + 1])
            d[~alive[ee, : new + 1] | (np.arange(new + 1) <= kk[:, None])] = np.inf
            near[ee, kk] = d.argmin(axis=1)
            far[ee, kk] = d[np.arange(len(ee)), near[ee, kk]]
    return History(left, right, distance, nodes)


@dataclass(frozen=True)
class Groups:
    """Groups of rows that lie one after another in ``values`` (row, column); ``sizes``: the number of rows of each."""

    sizes: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, groups: list[np.ndarray], columns: int) -> Groups:
        return cls(np.array([len(g) for g in groups], int), np.concatenate([np.zeros((0, columns)), *[np.reshape(g, (len(g), columns)) for g in groups]]).astype(float))

    def by_size(self, width: int = 600) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of groups with equally many rows, at most ``BUDGET`` bytes at a time by ``width`` bytes a row, and their rows as one array."""
        starts, order = np.cumsum(self.sizes) - self.sizes, np.argsort(self.sizes, kind="stable")
        sizes, first = np.unique(self.sizes[order], return_index=True)
        for n, own in zip(sizes.tolist(), np.split(order, first[1:]), strict=True):
            step = max(1, BUDGET // (width * max(n, 1)))
            for at in range(0, len(own) if n else 0, step):
                part = own[at : at + step]
                yield part, self.values[starts[part, None] + np.arange(n)]


def _by_size(groups: list[np.ndarray], width: int = 600) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``Groups.by_size`` of separate groups."""
    return Groups.of(groups, groups[0].shape[1]).by_size(width) if groups else iter(())


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... of each run, one run after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


@dataclass(frozen=True)
class Jets:
    """Jets of many events, event by event: ``counts`` of each event, four-vectors (E, px, py, pz), ``sizes`` and, jet by jet, the constituents' places."""

    counts: np.ndarray
    p4: np.ndarray
    sizes: np.ndarray
    constituents: np.ndarray

    def above(self, min_pt: float) -> Jets:
        kept = np.hypot(self.p4[:, 1], self.p4[:, 2]) >= min_pt
        counts = np.bincount(np.repeat(np.arange(len(self.counts)), self.counts)[kept], minlength=len(self.counts))
        return Jets(counts, self.p4[kept], self.sizes[kept], self.constituents[np.repeat(kept, self.sizes)])


def jets_of(events: Groups, radius: float, power: float = -1.0) -> Jets:
    """Inclusive jets of the e+e- generalised kt algorithm in each event (rows are E, px, py, pz), by energy, then first constituent."""
    scale = 1.0 - cos(radius) if radius <= np.pi else 3.0 + cos(radius)
    event, first, p4s, sizes, constituents = ([np.zeros(0, int)], [np.zeros(0, int)], [np.zeros((0, 4))], [np.zeros(0, int)], [np.zeros(0, int)])
    for part, p4 in events.by_size():
        n = p4.shape[1]
        h = recombined(p4, energy_metric(scale, power), lambda x: weight(x, power))
        rows = np.arange(len(part))
        final = np.broadcast_to(np.arange(2 * n), (len(part), 2 * n)).copy()  # the jet of each object, the last ones first
        for step in range(n - 1, -1, -1):
            merged = h.right[:, step] >= 0
            for side in (h.left, h.right):
                own = rows[merged]
                final[own, side[merged, step]] = final[own, n + step]
        order = np.argsort(final[:, :n], axis=1, kind="stable")
        jet = np.take_along_axis(final, order, axis=1)
        e, at = np.nonzero(np.diff(jet, axis=1, prepend=-1))
        event.append(part[e])
        first.append(order[e, at])
        p4s.append(h.nodes[e, jet[e, at]])
        sizes.append(np.diff(e * n + at, append=len(part) * n))
        constituents.append(order.ravel())
    event, first, p4, sizes = (np.concatenate(x) for x in (event, first, p4s, sizes))
    order = np.lexsort((first, -p4[:, 0], event))
    own = np.concatenate(constituents)[_runs((np.cumsum(sizes) - sizes)[order], sizes[order])]
    return Jets(np.bincount(event, minlength=len(events.sizes)), p4[order], sizes[order], own)


def jets_of_events(events: list[np.ndarray], radius: float, power: float = -1.0) -> list[list[tuple[np.ndarray, list[int]]]]:
    """``jets_of`` of separate events: (four-vector, constituents) of each jet."""
    found = jets_of(Groups.of(events, 4), radius, power)
    own = np.split(found.constituents, np.cumsum(found.sizes)[:-1]) if len(found.sizes) else []
    jets = [(p, c.tolist()) for p, c in zip(found.p4, own, strict=True)]
    ends = np.cumsum(found.counts)
    return [jets[a:b] for a, b in zip(ends - found.counts, ends, strict=True)]


def single_jets(rows: list[tuple], radius: float) -> list[tuple[tuple, list[int]]]:
    """``jets_of`` of one event of few particles (E, px, py, pz) in plain numbers, bit by bit the same: an array operation costs more than such an event."""
    scale = 1.0 - cos(radius) if radius <= np.pi else 3.0 + cos(radius)

    def made(e: float, x: float, y: float, z: float) -> tuple:
        w = e if e > 0 else 1.0
        return x, y, z, sqrt(x * x + y * y + z * z), 1.0 / (w * w), e

    def distance(a: tuple, b: tuple) -> float:
        size = a[3] * b[3]
        far = 1.0 - max(-1.0, min(1.0, (a[0] * b[0] + a[1] * b[1] + a[2] * b[2]) / size)) if size > 0 else 0.0
        return min(a[4], b[4]) * far / scale

    n = len(rows)
    objects = [made(*r) for r in rows]
    own = [[k] for k in range(n)]
    alive = list(range(n))  # ascending
    near, far = {}, {}  # nearest later object and its distance

    def search(i: int, later: list[int]) -> None:
        near[i], far[i] = -1, float("inf")
        for j in later:
            d = distance(objects[i], objects[j])
            if d < far[i]:
                near[i], far[i] = j, d

    for at, i in enumerate(alive):
        search(i, alive[at + 1 :])
    jets = []
    while alive:
        i, k = min(alive, key=far.__getitem__), min(alive, key=lambda x: objects[x][4])
        if objects[k][4] < far[i] or near[i] < 0:
            jets.append((objects[k], sorted(own[k])))
            alive.remove(k)
            gone = (k,)
        else:
            j, new = near[i], len(objects)
            a, b = objects[i], objects[j]
            objects.append(made(a[5] + b[5], a[0] + b[0], a[1] + b[1], a[2] + b[2]))
            own.append(own[i] + own[j])
            alive = [x for x in alive if x != i and x != j]
            gone = (i, j)
        for at, x in enumerate(alive):
            if near[x] in gone:
                search(x, alive[at + 1 :])
        if len(gone) == 2:
            for x in alive:
                d = distance(objects[x], objects[new])
                if d < far[x]:
                    near[x], far[x] = new, d
            alive.append(new)
            near[new], far[new] = -1, float("inf")
    jets.sort(key=lambda q: (-q[0][5], q[1][0]))
    return [((q[5], q[0], q[1], q[2]), c) for q, c in jets]


def groomed_masses(p4: np.ndarray, z_cut: float = 0.1, beta: float = 0.0, r0: float = 0.8, electron: bool = False) -> np.ndarray:
    """SoftDrop mass of many jets of n particles: trees (angular, or by ``electron`` energy-weighted) are opened from their roots until a split is balanced."""
    jets, n = p4.shape[:2]
    if n <= 1:
        return np.zeros(jets)
    h = recombined(p4, energy_metric() if electron else ANGULAR)
    pt = np.hypot(h.nodes[..., 1], h.nodes[..., 2])
    rows, at = np.arange(jets), np.full(jets, 2 * n - 2)
    walking, empty = np.ones(jets, bool), np.zeros(jets, bool)
    while walking.any():
        own = rows[walking]
        step = at[own] - n
        i, j, d = h.left[own, step], h.right[own, step], h.distance[own, step]
        a, b = pt[own, i], pt[own, j]
        both = a + b
        if electron:
            d = d / np.minimum(weight(h.nodes[own, i]), weight(h.nodes[own, j])) / (1.0 - np.cos(r0))
        else:
            d = d / r0
        ends = (both == 0) | (np.minimum(a, b) / np.where(both == 0, 1.0, both) > z_cut * d**beta)
        empty[own[both == 0]] = True
        at[own[~ends]] = np.where(a >= b, i, j)[~ends]
        walking[own[ends]] = False
        walking &= at >= n
    return np.where(empty, 0.0, invariant_mass(h.nodes[rows, at]))


def subjettiness(pt: np.ndarray, eta: np.ndarray, phi: np.ndarray, axes_eta: np.ndarray, axes_phi: np.ndarray, r0: float = 0.8) -> np.ndarray:
    """Sum of pt * min(nearest axis, r0), over the summed pt * r0, of many jets (jet, particle) with axes (jet, axis)."""
    near = np.full(pt.shape, r0)
    for k in range(axes_eta.shape[1]):
        near = np.minimum(near, np.hypot(eta - axes_eta[:, k, None], turned(phi, axes_phi[:, k, None])))
    return (pt * near).sum(axis=1) / (pt.sum(axis=1) * r0)


def iterated_axes(pt: np.ndarray, eta: np.ndarray, phi: np.ndarray, n: int, rounds: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Axes from the n hardest particles of each jet, moved to their particles' centres; an axis that loses all its particles goes to (0, 0)."""
    top = np.argsort(-pt, axis=1, kind="stable")[:, :n]
    a_eta, a_phi = np.take_along_axis(eta, top, axis=1), np.take_along_axis(phi, top, axis=1)
    for _ in range(rounds):
        d = np.stack([np.hypot(eta - a_eta[:, k, None], turned(phi, a_phi[:, k, None])) for k in range(a_eta.shape[1])])
        own = d.argmin(axis=0)
        for k in range(a_eta.shape[1]):
            w = pt * (own == k)
            total = w.sum(axis=1)
            a_eta[:, k] = (w * eta).sum(axis=1) / np.where(total > 0, total, 1.0)
            a_phi[:, k] = np.arctan2((w * np.sin(phi)).sum(axis=1), (w * np.cos(phi)).sum(axis=1))
    return a_eta, a_phi


def exclusive_axes(h: History, n_particles: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n objects that are left before the last n steps of histories with a beam; fewer steps cut the same tree higher up."""
    steps = n_particles - n
    alive = np.zeros((len(h.left), 2 * n_particles), bool)
    alive[:, :n_particles] = True
    rows = np.arange(len(h.left))
    for step in range(steps):
        pair = h.right[:, step] >= 0
        alive[rows, h.left[:, step]] = False
        alive[rows[pair], h.right[pair, step]] = False
        alive[rows[pair], n_particles + step] = True
    taken = np.argsort(~alive, axis=1, kind="stable")[:, :n]
    return eta_phi(np.take_along_axis(h.nodes, taken[:, :, None], axis=1))


SUBSTRUCTURE = ("sdmass", "sdmass_ee", *(f"tau{n}" for n in range(1, 5)), *(f"tau{n}_ee" for n in range(1, 5)))


def substructure_in(groups: Groups, r0: float = 0.8, names: tuple[str, ...] = SUBSTRUCTURE) -> np.ndarray:
    """``names`` of each group of particles (rows are pt, eta, phi), NaN for an empty one: groomed masses, subjettiness for iterated axes and for exclusive subjets.

    Only what is named is made.
    """
    out = np.full((len(groups.sizes), len(names)), np.nan)
    exclusive = any(x.startswith("tau") and x.endswith("_ee") for x in names)
    for part, rows in groups.by_size():
        pt, eta, phi = rows[..., 0], rows[..., 1], rows[..., 2]
        n, p4 = rows.shape[1], massless(pt, eta, phi)
        h = recombined(p4, energy_metric(1.0 - np.cos(r0)), weight) if exclusive and n > 1 else None
        for place, name in enumerate(names):
            if name.startswith("sdmass"):
                out[part, place] = groomed_masses(p4, r0=r0, electron=name == "sdmass_ee")
                continue
            k = int(name[3])
            if name.endswith("_ee"):
                out[part, place] = subjettiness(pt, eta, phi, *exclusive_axes(h, n, k), r0) if n > k else 0.0
            else:  # fewer particles than axes: the missing axes are at (0, 0)
                short = np.zeros((len(part), max(0, k - n)))
                a_eta, a_phi = iterated_axes(pt, eta, phi, min(k, n))
                out[part, place] = subjettiness(pt, eta, phi, np.hstack([a_eta, short]), np.hstack([a_phi, short]), r0)
    return out


def substructure_of(groups: list[np.ndarray], r0: float = 0.8) -> np.ndarray:
    """SUBSTRUCTURE of separate groups."""
    return substructure_in(Groups.of(groups, 3), r0)


def batched_thrust(p3: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Largest sum of |p . n| over the summed |p| by iteration from the total momentum (a local maximum), NaN without momentum; p3 is (events, n, 3), short events filled with zeros."""
    size, total = np.linalg.norm(p3, axis=2).sum(axis=1), p3.sum(axis=1)
    length = np.linalg.norm(total, axis=1)
    ok = (size > 0) & (length > 0)
    n = total / np.where(length > 0, length, 1.0)[:, None]
    moving = ok.copy()
    for _ in range(rounds):
        own = np.flatnonzero(moving)
        if not len(own):
            break
        new = (np.sign((p3[own] * n[own, None, :]).sum(axis=2))[:, :, None] * p3[own]).sum(axis=1)
        length = np.linalg.norm(new, axis=1)
        new = new / np.where(length > 0, length, 1.0)[:, None]
        done = (length == 0) | np.isclose(new, n[own]).all(axis=1)
        n[own[~done]] = new[~done]
        moving[own[done]] = False
    return np.where(ok, np.abs((p3 * n[:, None, :]).sum(axis=2)).sum(axis=1) / np.where(ok, size, 1.0), np.nan)


# --- over DataFrames -------------------------------------------------------------------------------


def _gathered(particles: DataFrame, keys: tuple[str, ...], fields: tuple[str, ...]) -> DataFrame:
    return particles.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pidx", *fields))).alias("c"))


def _groups(*lists: pa.Array) -> Groups:
    """The rows' lists as columns, without Python objects for rows or values; NULL rows are empty."""
    sizes = pc.fill_null(pc.list_value_length(lists[0]), 0).to_numpy(zero_copy_only=False).astype(int)
    return Groups(sizes, np.column_stack([x.flatten().to_numpy(zero_copy_only=False).astype(float) for x in lists]))


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())


JETS = pa.list_(pa.struct([("px", pa.float64()), ("py", pa.float64()), ("pz", pa.float64()), ("energy", pa.float64()), ("constituents", pa.list_(pa.int32()))]))
JETS_SCHEMA = "array<struct<px: double, py: double, pz: double, energy: double, constituents: array<int>>>"


def with_jets(events: DataFrame, radius: dict[str, float], power: float = -1.0, min_pt: float = 0.0) -> DataFrame:
    """Adds ``<list>_jets`` for each named list of particles (structs with energy, px, py, pz): the list's jets, with constituents by place.

    All lists of an event are clustered in one pass, and only the four numbers of each particle go to it.
    """

    def kernel(r: float) -> Callable:
        def jets(energy: pa.Array, px: pa.Array, py: pa.Array, pz: pa.Array) -> pa.Array:
            found = jets_of(_groups(energy, px, py, pz), r, power).above(min_pt)
            own = pa.ListArray.from_arrays(_offsets(found.sizes), pa.array(found.constituents, pa.int32()))
            columns = [*[pa.array(np.ascontiguousarray(found.p4[:, k])) for k in (1, 2, 3, 0)], own]
            return pa.ListArray.from_arrays(_offsets(found.counts), pa.StructArray.from_arrays(columns, fields=list(JETS.value_type)))

        return F.arrow_udf(jets, JETS_SCHEMA)

    made = {f"{name}_jets": kernel(r)(*[F.col(f"{name}.{c}") for c in ("energy", "px", "py", "pz")]) for name, r in radius.items()}
    return events.withColumns(made)


def cluster(particles: DataFrame, radius: float = 0.4, power: float = -1.0, min_pt: float = 0.0) -> DataFrame:
    """event_id, jet_id, px, py, pz, energy, constituents (pidx) of every jet."""
    lists = with_jets(_gathered(particles, ("event_id",), ("energy", "px", "py", "pz")), {"c": radius}, power, min_pt)
    rows = lists.select("event_id", "c", F.posexplode("c_jets").alias("jet_id", "j"))
    ids = F.transform("j.constituents", lambda i: F.get(F.col("c.pidx"), i).cast("int"))
    return rows.select("event_id", "jet_id", "j.px", "j.py", "j.pz", "j.energy", ids.alias("constituents"))


def with_substructure(rows: DataFrame, particles: str, r0: float = 0.8, names: tuple[str, ...] = SUBSTRUCTURE) -> DataFrame:
    """Adds ``names`` of SUBSTRUCTURE of the list ``particles`` (structs with pt, eta, phi) to each row, NULL for an empty list; only these three lists leave the row."""
    kind = pa.struct([(n, pa.float64()) for n in names])

    def values(pt: pa.Array, eta: pa.Array, phi: pa.Array) -> pa.Array:
        made = substructure_in(_groups(pt, eta, phi), r0, names)
        return pa.StructArray.from_arrays([pa.array(c, pa.float64(), from_pandas=True) for c in made.T], fields=list(kind))

    kernel = F.arrow_udf(values, "struct<" + ", ".join(f"{n}: double" for n in names) + ">")
    out = rows.withColumn("__made", kernel(*[F.col(f"{particles}.{c}") for c in ("pt", "eta", "phi")]))
    return out.select(*rows.columns, *[F.col(f"__made.{n}").alias(n) for n in names])


def substructure_lists(pt: Column, eta: Column, phi: Column, names: tuple[str, ...], r0: float = 0.8) -> Column:
    """array<struct<names>>: the same of every jet of an event, from lists of the jets' lists."""
    kind = pa.struct([(n, pa.float64()) for n in names])

    def values(*lists: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(lists[0]), 0).to_numpy(zero_copy_only=False).astype(int)
        made = substructure_in(_groups(*[x.flatten() for x in lists]), r0, names)
        return pa.ListArray.from_arrays(_offsets(sizes), pa.StructArray.from_arrays([pa.array(c, pa.float64(), from_pandas=True) for c in made.T], fields=list(kind)))

    return F.arrow_udf(values, "array<struct<" + ", ".join(f"{n}: double" for n in names) + ">>")(pt, eta, phi)


def substructure(constituents: DataFrame, keys: tuple[str, ...] = ("event_id", "jet_id"), r0: float = 0.8) -> DataFrame:
    """keys and SUBSTRUCTURE of each group of particles (pidx, pt, eta, phi)."""
    return with_substructure(_gathered(constituents, keys, ("pt", "eta", "phi")), "c", r0).drop("c")


def thrust_in(events: Groups) -> np.ndarray:
    """Thrust of each event (rows are px, py, pz), NaN without momentum."""
    out = np.full(len(events.sizes), np.nan)
    for part, p3 in events.by_size(120):
        out[part] = batched_thrust(p3)
    return out


def thrust_of(events: list[np.ndarray]) -> np.ndarray:
    """``thrust_in`` of separate events."""
    return thrust_in(Groups.of(events, 3))


def single_thrust(rows: list[tuple], rounds: int = 100, few: int = 100) -> float:
    """``batched_thrust`` of one event: for few particles in plain numbers, because an array operation costs more than such an event."""
    if len(rows) > few or any(x is None for row in rows for x in row):
        return float(thrust_of([np.array(rows, float)])[0])
    size = sum(sqrt(x * x + y * y + z * z) for x, y, z in rows)
    sums = [sum(c) for c in zip(*rows, strict=True)]
    length = sqrt(sum(c * c for c in sums))
    if not (size > 0 and length > 0):
        return float("nan")
    a, b, c = (v / length for v in sums)
    for _ in range(rounds):
        p = q = r = 0.0
        for x, y, z in rows:
            d = x * a + y * b + z * c
            if d > 0:
                p, q, r = p + x, q + y, r + z
            elif d < 0:
                p, q, r = p - x, q - y, r - z
        length = sqrt(p * p + q * q + r * r)
        if length == 0:
            break
        p, q, r = p / length, q / length, r / length
        if all(abs(new - old) <= 1e-8 + 1e-5 * abs(old) for new, old in ((p, a), (q, b), (r, c))):
            break
        a, b, c = p, q, r
    return sum(abs(x * a + y * b + z * c) for x, y, z in rows) / size


def list_thrust(particles: str) -> Column:
    """Thrust of the list ``particles`` (structs with px, py, pz)."""
    kernel = F.arrow_udf(lambda px, py, pz: pa.array(thrust_in(_groups(px, py, pz)), pa.float64()), "double")
    return kernel(*[F.col(f"{particles}.{c}") for c in ("px", "py", "pz")])


def event_thrust(particles: DataFrame) -> DataFrame:
    """event_id, thrust."""
    return _gathered(particles, ("event_id",), ("px", "py", "pz")).select("event_id", list_thrust("c").alias("thrust"))
