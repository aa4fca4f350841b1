"""The clustering kernels one event or jet at a time: what the batched ones are tested against."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from jetloom.operators.clustering import *  # noqa: F403
from jetloom.operators.clustering import massless


def angles(p4: np.ndarray) -> np.ndarray:
    """1 - cos of the angle between every two momenta (rows are E, px, py, pz); 0 if one has no momentum."""
    size = np.linalg.norm(p4[:, 1:], axis=1)
    unit = p4[:, 1:] / np.where(size > 0, size, 1.0)[:, None]
    return np.where((size[:, None] > 0) & (size[None, :] > 0), 1.0 - np.clip(unit @ unit.T, -1.0, 1.0), 0.0)


def eta_phi(p4: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pt = np.hypot(p4[:, 1], p4[:, 2])
    return np.where(pt > 0, np.arcsinh(p4[:, 3] / np.where(pt > 0, pt, 1.0)), 0.0), np.where(pt > 0, np.arctan2(p4[:, 2], p4[:, 1]), 0.0)


def delta_r(p4: np.ndarray) -> np.ndarray:
    eta, phi = eta_phi(p4)
    d = phi[:, None] - phi[None, :]
    return np.hypot(eta[:, None] - eta[None, :], np.arctan2(np.sin(d), np.cos(d)))


def weight(p4: np.ndarray, power: float = -1.0) -> np.ndarray:
    """E to twice the power; an object without energy counts as 1."""
    e = p4[:, 0]
    return np.where(e > 0, np.where(e > 0, e, 1.0) ** (2 * power), 1.0)


def energy_distance(p4: np.ndarray) -> np.ndarray:
    w = weight(p4)
    return np.minimum(w[:, None], w[None, :]) * angles(p4)


def recombine(p4: np.ndarray, pair: Callable, beam: Callable | None = None, stop: int = 1) -> tuple[list, list, np.ndarray]:
    """Smallest distance first until ``stop`` objects remain.

    Returns (merges as (i, j, distance, new node), nodes taken by the beam, four-vectors of
    all nodes). Without ``beam`` only pairs merge. Ties go to the smaller (i, j), a pair
    before the beam. Four-vectors are added.
    """
    nodes, live = [np.asarray(x, float) for x in p4], list(range(len(p4)))
    merges, final = [], []
    while len(live) > (stop if beam is None or stop > 1 else 0):
        now = np.array([nodes[i] for i in live])
        best, where = np.inf, None
        if len(live) > 1:
            d = pair(now)
            d[np.tril_indices(len(live))] = np.inf
            k = int(np.argmin(d))
            best, where = d.flat[k], divmod(k, len(live))
        if beam is not None:
            b = beam(now)
            k = int(np.argmin(b))
            if b[k] < best:
                final.append(live.pop(k))
                continue
        if where is None:
            break
        i, j = live[where[0]], live[where[1]]
        merges.append((i, j, float(best), len(nodes)))
        nodes.append(nodes[i] + nodes[j])
        live = [x for x in live if x not in (i, j)] + [len(nodes) - 1]
    return merges, final + (live if beam is not None and stop > 1 else []), np.array(nodes)


def genkt_jets(p4: np.ndarray, radius: float, power: float = -1.0) -> list[tuple[np.ndarray, list[int]]]:
    """Inclusive jets of the e+e- generalised kt algorithm: (four-vector, constituents), by energy, then first constituent."""
    if not len(p4):
        return []
    scale = 1.0 - np.cos(radius) if radius <= np.pi else 3.0 + np.cos(radius)
    pair = lambda n: np.minimum(weight(n, power)[:, None], weight(n, power)[None, :]) * angles(n) / scale
    merges, final, nodes = recombine(p4, pair, lambda n: weight(n, power))
    inside = {i: [i] for i in range(len(p4))}
    for i, j, _, new in merges:
        inside[new] = inside[i] + inside[j]
    jets = [(nodes[k], sorted(inside[k])) for k in final]
    return sorted(jets, key=lambda x: (-x[0][0], x[1][0]))


def invariant_mass(p: np.ndarray) -> float:
    return float(np.sqrt(max(0.0, p[0] ** 2 - p[1] ** 2 - p[2] ** 2 - p[3] ** 2)))


def groomed_mass(p4: np.ndarray, z_cut: float = 0.1, beta: float = 0.0, r0: float = 0.8, electron: bool = False) -> float:
    """SoftDrop mass: the tree (angular, or by ``electron`` energy-weighted) is opened from its root until a split is balanced."""
    if len(p4) <= 1:
        return 0.0
    merges, _, nodes = recombine(p4, energy_distance if electron else delta_r)
    split = {new: (i, j, d) for i, j, d, new in merges}
    at = len(nodes) - 1
    while at in split:
        i, j, d = split[at]
        a, b = np.hypot(*nodes[i][1:3]), np.hypot(*nodes[j][1:3])
        if a + b == 0:
            return 0.0
        if electron:
            d = d / min(weight(nodes[[i, j]])) / (1.0 - np.cos(r0))
        else:
            d = d / r0
        if min(a, b) / (a + b) > z_cut * d**beta:
            break
        at = i if a >= b else j
    return invariant_mass(nodes[at])


def subjettiness(pt: np.ndarray, eta: np.ndarray, phi: np.ndarray, axes_eta: np.ndarray, axes_phi: np.ndarray, r0: float = 0.8) -> float:
    """Sum of pt * min(nearest axis, r0), over the summed pt * r0."""
    d = phi[:, None] - axes_phi[None, :]
    near = np.minimum(np.hypot(eta[:, None] - axes_eta[None, :], np.arctan2(np.sin(d), np.cos(d))).min(axis=1), r0)
    return float((pt * near).sum() / (pt.sum() * r0))


def iterated_axes(pt: np.ndarray, eta: np.ndarray, phi: np.ndarray, n: int, rounds: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Axes from the n hardest particles, moved to their particles' centres; an axis that loses all its particles goes to (0, 0)."""
    top = np.argsort(-pt, kind="stable")[:n]
    a_eta, a_phi = eta[top], phi[top]
    for _ in range(rounds):
        d = phi[:, None] - a_phi[None, :]
        own = np.hypot(eta[:, None] - a_eta[None, :], np.arctan2(np.sin(d), np.cos(d))).argmin(axis=1)[None, :] == np.arange(n)[:, None]
        w = pt * own
        total = w.sum(axis=1)
        a_eta = (w * eta).sum(axis=1) / np.where(total > 0, total, 1.0)
        a_phi = np.arctan2((w * np.sin(phi)).sum(axis=1), (w * np.cos(phi)).sum(axis=1))
    return a_eta, a_phi


def exclusive_axes(p4: np.ndarray, n: int, radius: float = 0.8) -> tuple[np.ndarray, np.ndarray]:
    scale = 1.0 - np.cos(radius)
    if n > 1:
        _, last, nodes = recombine(p4, lambda x: energy_distance(x) / scale, weight, stop=n)
        taken = nodes[last[-n:]]
    else:  # the last object before the beam takes it
        merges, final, nodes = recombine(p4, lambda x: energy_distance(x) / scale, weight)
        taken = nodes[final[-1:]]
    return eta_phi(taken)


def thrust(p3: np.ndarray, rounds: int = 100) -> float:
    """Largest sum of |p . n| over the summed |p|, by iteration from the total momentum (a local maximum); NaN without momentum."""
    size = np.linalg.norm(p3, axis=1).sum()
    n = p3.sum(axis=0)
    if size == 0 or np.linalg.norm(n) == 0:
        return float("nan")
    n = n / np.linalg.norm(n)
    for _ in range(rounds):
        new = (np.sign(p3 @ n)[:, None] * p3).sum(axis=0)
        if np.linalg.norm(new) == 0:
            break
        new = new / np.linalg.norm(new)
        if np.allclose(new, n):
            break
        n = new
    return float(np.abs(p3 @ n).sum() / size)


def substructure_of(pt: np.ndarray, eta: np.ndarray, phi: np.ndarray, r0: float = 0.8) -> list[float]:
    """SUBSTRUCTURE of one group of particles: both groomed masses, subjettiness for iterated axes and for exclusive subjets."""
    p4 = massless(pt, eta, phi)
    out = [groomed_mass(p4, r0=r0), groomed_mass(p4, r0=r0, electron=True)]
    for n in range(1, 5):  # fewer particles than axes: the missing axes are at (0, 0)
        short = np.zeros(max(0, n - len(pt)))
        a_eta, a_phi = iterated_axes(pt, eta, phi, min(n, len(pt)))
        out.append(subjettiness(pt, eta, phi, np.concatenate([a_eta, short]), np.concatenate([a_phi, short]), r0))
    for n in range(1, 5):
        out.append(0.0 if len(pt) <= n else subjettiness(pt, eta, phi, *exclusive_axes(p4, n, r0), r0))
    return out
