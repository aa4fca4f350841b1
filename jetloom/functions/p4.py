"""Four-vector algebra and detector geometry as Column expressions.

A four-vector is a struct<pt, eta, phi, energy: double>; every function takes and
gives Columns, so all of it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def finite(x) -> Column:
    """Neither NaN nor infinite (NaN compares as largest in SQL, so it is tested by name)."""
    return ~F.isnan(col(x)) & (F.abs(col(x)) < float("inf"))


def np_div(a, b) -> Column:
    """Division by IEEE rules: x/0 is an infinity of x's sign, 0/0 is NaN."""
    a, b = col(a), col(b)
    zero = F.when(a > 0, float("inf")).when(a < 0, float("-inf")).otherwise(float("nan"))
    return F.when(b == 0, zero).otherwise(a / F.when(b == 0, 1.0).otherwise(b))


def nan_to_zero(x) -> Column:
    """0 for NULL and NaN, the largest doubles for infinities."""
    x, top = col(x), 1.7976931348623157e308
    return F.when(x.isNull() | F.isnan(x), 0.0).otherwise(F.greatest(F.lit(-top), F.least(F.lit(top), x)))


def px(pt, phi) -> Column:
    return col(pt) * F.cos(col(phi))


def py(pt, phi) -> Column:
    return col(pt) * F.sin(col(phi))


def pz(pt, eta) -> Column:
    return col(pt) * F.sinh(col(eta))


def p(pt, eta) -> Column:
    return col(pt) * F.cosh(col(eta))


def theta(eta) -> Column:
    return 2 * F.atan(F.exp(-col(eta)))


def mass(pt, eta, energy) -> Column:
    return F.sqrt(F.greatest(col(energy) * col(energy) - p(pt, eta) * p(pt, eta), F.lit(0.0)))


def from_cartesian(x, y, z, energy=None, m=None) -> Column:
    """The struct from momentum components and an energy or a mass; eta is 0 where there is no momentum."""
    x, y, z = col(x), col(y), col(z)
    pt = F.sqrt(x * x + y * y)
    e = col(energy) if energy is not None else F.sqrt(x * x + y * y + z * z + col(m) * col(m))
    flat = F.when(z > 0, float("inf")).when(z < 0, float("-inf")).otherwise(0.0)
    eta = F.when(pt == 0, flat).otherwise(F.asinh(z / F.when(pt == 0, 1.0).otherwise(pt)))
    return F.struct(pt.alias("pt"), eta.alias("eta"), F.atan2(y, x).alias("phi"), e.alias("energy"))


def zero_p4() -> Column:
    return F.struct(*[F.lit(0.0).alias(c) for c in ("pt", "eta", "phi", "energy")])


def signed_delta_phi(a, b) -> Column:
    d = col(a) - col(b)
    return F.atan2(F.sin(d), F.cos(d))


def delta_phi(a, b) -> Column:
    return F.abs(signed_delta_phi(a, b))


def delta_eta(a, b) -> Column:
    return F.abs(col(a) - col(b))


def delta_theta(eta_a, eta_b) -> Column:
    return F.abs(theta(eta_a) - theta(eta_b))


def delta_r(eta_a, phi_a, eta_b, phi_b) -> Column:
    return F.sqrt(F.pow(delta_eta(eta_a, eta_b), 2) + F.pow(delta_phi(phi_a, phi_b), 2))


def delta_r_theta(eta_a, phi_a, eta_b, phi_b) -> Column:
    return F.sqrt(F.pow(delta_theta(eta_a, eta_b), 2) + F.pow(delta_phi(phi_a, phi_b), 2))


def angle_3d(ax, ay, az, bx, by, bz) -> Column:
    """Angle between two momenta; the cosine is clamped, a zero momentum gives NULL."""
    a, b = [col(c) for c in (ax, ay, az)], [col(c) for c in (bx, by, bz)]
    dot = sum((x * y for x, y in zip(a, b, strict=True)), F.lit(0.0))
    size = F.sqrt(sum((x * x for x in a), F.lit(0.0)) * sum((x * x for x in b), F.lit(0.0)))
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(dot, size))))


def safe_log(x, floor: float = 1e-6) -> Column:
    return F.ln(F.greatest(col(x), F.lit(floor)))


def sign_from(x) -> Column:
    """+1 for zero and above, else -1."""
    return F.when(col(x) >= 0, 1.0).otherwise(-1.0)


def linspace(lo: float, hi: float, edges: int) -> list[float]:
    step = (hi - lo) / (edges - 1)
    return [lo + i * step for i in range(edges - 1)] + [hi]


def logspace(lo: float, hi: float, edges: int) -> list[float]:
    return [10.0**x for x in linspace(lo, hi, edges)]


def digitize(x, edges: list[float]) -> Column:
    """Number of edges at or below x (0 for NULL and NaN, which are in no bin)."""
    x = col(x)
    count = F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e <= x))
    return F.when(x.isNull() | F.isnan(x), 0).otherwise(count)


def uniform_bin(x, lo: float, hi: float, bins: int, last_closed: bool = True) -> Column:
    """Bin 0 .. bins-1 of equal width, -1 below and NULL/NaN, ``bins`` above; arithmetic first, then set right at the edges.

    ``last_closed``: the upper edge belongs to the last bin.
    """
    x, step = col(x), (hi - lo) / bins
    edge = lambda i: F.lit(float(lo)) + i * F.lit(step)
    guess = F.floor((x - F.lit(float(lo))) / F.lit(step))
    guess = guess - F.when(x < edge(guess), 1).otherwise(0) + F.when(x >= edge(guess + 1), 1).otherwise(0)
    top = x <= F.lit(float(hi)) if last_closed else x < F.lit(float(hi))
    inside = F.greatest(F.lit(0), F.least(F.lit(bins - 1), guess))
    bin_ = F.when(x.isNull() | F.isnan(x) | (x < F.lit(float(lo))), -1).when(~top, bins).otherwise(inside)
    return bin_.cast("int")
