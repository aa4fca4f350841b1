"""Declared sets of histograms, all filled in one scan.

A set is a list of tables, each with one or two axes, a weight and a condition, over a row's values or over each
element of one of its lists. One generator gives a row (table, bin, bin, weight) for each value that is on its table's
axes, and one aggregation adds them up, on the map side first; what is shuffled is a row for each bin and task.
Axes that depend on the data get their ends from one scan before, which takes the least and largest values of all of them together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from math import log10

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jetloom.functions import p4, pdg
from jetloom.functions.p4 import col, digitize, linspace, logspace, uniform_bin

from . import validation

Value = Column | str | Callable[[Column], Column]


@dataclass(frozen=True)
class Axis:
    """Edges of one dimension.

    ``flow``: ``drop`` (values beyond are dropped, the last bin is closed), ``bins`` (bins are right-open; beyond are bins -1 and the
    number of bins), ``sum`` (beyond counts in the outer bins). ``spans``: the ends are the least and largest value of the rows under
    this condition, or with ``top_of`` zero and the largest of that; ``log``: bins are equal in the logarithm, and only positive values count.
    """

    lo: float = 0.0
    hi: float = 1.0
    bins: int = 50
    edges: tuple[float, ...] = ()
    flow: str = "drop"
    log: bool = False
    spans: Column | str | None = None
    top_of: Column | None = None

    def __post_init__(self) -> None:
        if self.flow not in ("drop", "bins", "sum"):
            raise ValueError(f"flow is drop, bins or sum, not {self.flow!r}")
        if list(self.edges) != sorted({*self.edges}):
            raise ValueError("edges must ascend")

    def all_edges(self) -> list[float]:
        if self.edges:
            return list(self.edges)
        return logspace(self.lo, self.hi, self.bins + 1) if self.log else linspace(self.lo, self.hi, self.bins + 1)

    def n(self) -> int:
        return len(self.edges) - 1 if self.edges else self.bins

    def _log_place(self, x: Column, edges: list[float]) -> Column:
        """``digitize`` less one by arithmetic, set right at the edges, instead of a look at every edge."""
        guess = F.floor((F.log10(x) - self.lo) / ((self.hi - self.lo) / self.bins))
        return F.when(x > 0, _by_guess(guess, x, edges)).otherwise(-1)

    def place(self, x: Column) -> Column:
        """The value's bin, NULL off the axis. ``lo`` and ``hi`` are exponents of ten of a logarithmic axis."""
        n, known = self.n(), x.isNotNull() & ~F.isnan(x)
        if self.edges or self.log:
            edges = self.all_edges()
            b = digitize(x, edges) - 1 if self.edges else self._log_place(x, edges)
            b = b if self.flow == "bins" else F.when(x == edges[-1], n - 1).otherwise(b)
        else:
            b = uniform_bin(x, self.lo, self.hi, n, last_closed=self.flow != "bins")
        if self.flow == "sum":
            b = F.greatest(F.lit(0), F.least(F.lit(n - 1), b))
        inside = known if self.flow != "drop" else known & b.between(0, n - 1)
        return F.when(inside, b.cast("int"))


def _by_guess(guess: Column, x: Column, edges: list[float]) -> Column:
    """Number of edges at or below x, less one, from a guess that is off by one at most."""
    known, last = F.array(*[F.lit(float(e)) for e in edges]), len(edges) - 1
    b = F.greatest(F.lit(0), F.least(F.lit(last), guess)).cast("int")
    return b - F.when(x < F.get(known, b), 1).otherwise(0) + F.when(x >= F.get(known, b + 1), 1).otherwise(0)


def log_axis(lo: float, hi: float, bins: int, flow: str = "drop") -> Axis:
    """Between two powers of ten."""
    return Axis(lo, hi, bins, flow=flow, log=True)


@dataclass(frozen=True)
class Table:
    """``each``: a list whose elements are filled one by one; x, y, weight and where are then functions of the element, or the row's columns."""

    name: str
    x: Value
    axis: Axis
    y: Value | None = None
    y_axis: Axis | None = None
    weight: Value | None = None
    where: Value | None = None
    each: str | None = None

    def __post_init__(self) -> None:
        if (self.y is None) != (self.y_axis is None):
            raise ValueError(f"{self.name}: a second value needs a second axis")

    def values(self) -> Column:
        """An array of (x, y, w) of the row, NULL where the condition does not hold."""

        def of(e: Column | None) -> Column:
            get = lambda v, other: other if v is None else v(e) if callable(v) and not isinstance(v, (str, Column)) else col(v)
            w = get(self.weight, F.lit(1.0)).cast("double")
            holds = get(self.where, F.lit(True))
            return F.struct(get(self.x, None).cast("double").alias("x"), get(self.y, F.lit(0.0)).cast("double").alias("y"), F.when(holds, w).alias("w"))

        if not self.each:
            return F.array(of(None))
        if self.where is None or callable(self.where) and not isinstance(self.where, (str, Column)):
            return F.transform(F.expr(self.each), of)
        return F.when(col(self.where), F.transform(F.expr(self.each), of))  # a row's condition spares its list


def _numbers(table: Table, d: str, positive: bool) -> Column:
    """The row's values in dimension ``d`` that can be on an axis."""
    known = F.filter(table.values(), lambda v: v.w.isNotNull() & v[d].isNotNull() & ~F.isnan(v[d]) & ((v[d] > 0) if positive else F.lit(True)))
    return F.transform(known, lambda v: v[d])


def _entries(table: Table, number: int) -> Column:
    """An array of (t, x_bin, y_bin, w) of the row's values that are on the table's axes."""
    two = table.y_axis is not None
    y_bin = lambda v: table.y_axis.place(v.y) if two else F.lit(None).cast("int")
    placed = F.transform(table.values(), lambda v: F.struct(F.lit(number).alias("t"), table.axis.place(v.x).alias("x_bin"), y_bin(v).alias("y_bin"), v.w.alias("w")))
    kept = F.filter(placed, lambda e: e.w.isNotNull() & e.x_bin.isNotNull() & (e.y_bin.isNotNull() if two else F.lit(True)))
    return F.coalesce(kept, F.array())


def resolved(df: DataFrame, tables: list[Table]) -> list[Table]:
    """The tables with the ends of their axes; those that depend on the data take one scan for all."""
    asked: dict[str, Column] = {}
    for n, t in enumerate(tables):
        for d, axis in (("x", t.axis), ("y", t.y_axis)):
            if axis is not None and axis.spans is not None:
                holds = F.expr(axis.spans) if isinstance(axis.spans, str) else axis.spans
                inside = F.when(holds, _numbers(t, d, axis.log))
                if axis.top_of is not None:
                    asked[f"hi_{d}{n}"] = F.max(F.when(holds & ~F.isnan(axis.top_of) & F.exists(t.values(), lambda v: v.w.isNotNull()), axis.top_of))
                    continue
                asked |= {f"lo_{d}{n}": F.min(F.array_min(inside)), f"hi_{d}{n}": F.max(F.array_max(inside))}
    if not asked:
        return tables
    ends = df.agg(*[c.alias(k) for k, c in asked.items()]).first()

    def fixed(axis: Axis | None, key: str) -> Axis | None:
        if axis is None or axis.spans is None:
            return axis
        lo, hi = 0.0 if axis.top_of is not None else ends[f"lo_{key}"], ends[f"hi_{key}"]
        if lo is None or hi is None:
            return replace(axis, spans=None, log=False, lo=0.0, hi=1.0)
        if axis.log:
            inner = logspace(log10(lo), log10(hi), axis.bins + 1)[1:-1]
            return replace(axis, spans=None, log=False, edges=(lo, *inner, hi) if hi > lo else (lo, 2 * lo))
        return replace(axis, spans=None, lo=lo, hi=hi if hi > lo else lo + 1.0)

    return [replace(t, axis=fixed(t.axis, f"x{n}"), y_axis=fixed(t.y_axis, f"y{n}")) for n, t in enumerate(tables)]


def exact_sum(x: str) -> Column:
    """The sum of a column as if rounded once, so that it does not hang on the order of its rows.

    The part of each value above 2^-20 adds up without rounding until the sum is 2^33, and what is left of the values is too small for its rounding to count.
    Values of 2^33 and more, and infinite ones, are added as they are.
    """
    value, unit = F.col(x), 2.0**20
    high = F.when(F.abs(value) < 2.0**33, F.rint(value * unit) / unit).otherwise(value)
    low = F.when(F.abs(value) < 2.0**33, value - F.rint(value * unit) / unit).otherwise(0.0)
    return F.sum(high) + F.sum(low)


def filled(df: DataFrame, tables: list[Table], keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, name, x_bin, y_bin (NULL for one dimension), n (entries), value (sum of weights) of the bins that have something."""
    if len({t.name for t in tables}) < len(tables):
        raise ValueError("tables need names of their own")
    tables = resolved(df, tables)
    entries = reduce(lambda a, b: F.concat(a, b), [_entries(t, n) for n, t in enumerate(tables)])
    rows = df.select(*keys, F.inline(entries))
    sums = rows.groupBy(*keys, "t", "x_bin", "y_bin").agg(F.count("*").alias("n"), exact_sum("w").alias("value"))
    name = F.get(F.array(*[F.lit(t.name) for t in tables]), F.col("t"))
    return sums.select(*keys, name.alias("name"), "x_bin", "y_bin", "n", "value")


def edges_of(df: DataFrame, tables: list[Table]) -> DataFrame:
    """name, dimension, bin, lo, hi of every bin of the tables' axes."""
    rows = []
    for t in resolved(df, tables):
        for d, axis in (("x", t.axis), ("y", t.y_axis)):
            edges = axis.all_edges() if axis else []
            rows += [(t.name, d, i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    return df.sparkSession.createDataFrame(rows, "name string, dimension string, bin int, lo double, hi double")


def shares(hist: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``hist`` with the share of each bin in its table, of entries and of weights."""
    own = Window.partitionBy(*keys, "name")
    return hist.withColumns({"n_share": F.try_divide("n", F.sum("n").over(own)), "value_share": F.try_divide("value", F.sum("value").over(own))})


# The usual axes.
IMPACT_AXES = {"dxy": (-3.0, 1.0), "dz": (-3.0, 1.0), "d3": (-3.0, 2.0)}
SIGMA_AXIS = log_axis(-4.0, 0.0, 79)
SHAPE_AXIS = Axis(*validation.SHAPE[:2], validation.SHAPE[2])
CANDS_AXIS = Axis(1.0, 11.0, 10)


def standard_tables(columns: list[str], background: Column | str = "not is_signal") -> list[Table]:
    """The validation set over jets in the merged format, with ``cls_weight`` where it has been added; tables whose columns are not there are left out.

    Kinematics of the generated jet by its weight, in 50 bins over the range of the background; masses and candidates of jets; energies;
    lifetime variables and their errors by candidate; decay modes; candidates by mode; shapes, also by mode.
    """
    have = lambda *names: {*names} <= {*columns}
    weight = "cls_weight" if have("cls_weight") else None
    gen, reco = F.col("gen_jet_p4"), F.col("reco_jet_p4")
    vis = F.col("gen_jet_tau_p4")
    spread = Axis(bins=50, spans=background)
    mass = lambda v: p4.mass(v["rho"], v["eta"], v["t"])
    out = []
    if have("gen_jet_p4"):
        moving = {"pt": gen["rho"], "eta": gen["eta"], "theta": F.degrees(p4.theta(gen["eta"])), "p": p4.p(gen["rho"], gen["eta"]), "mass": mass(gen)}
        out += [Table(f"gen_jet_{k}", v, spread, weight=weight) for k, v in moving.items()]
    n_cands = F.size("reco_cand_p4s").cast("double")
    if have("reco_cand_p4s"):
        out += [Table("n_cands", n_cands, spread, weight=weight), Table("n_particles", n_cands, Axis(*validation.N_CANDS))]
    if have("reco_jet_p4"):
        out += [Table("reco_jet_pt", reco["rho"], Axis(*validation.JET_PT, flow="sum")), Table("reco_jet_mass", mass(reco), Axis(0.0, 10.0, 50))]
    if have("reco_jet_p4", "reco_cand_p4s"):
        out.append(Table("n_cands_by_pt", n_cands, Axis(*validation.N_CANDS), reco["rho"], Axis(bins=50, spans="true", log=True)))
    mode = F.col("gen_jet_tau_decaymode")
    if have("gen_jet_tau_decaymode"):
        out.append(Table("decaymode", mode, Axis(*validation.MODES)))
        plotted = pdg.plot_mode(mode)
        if have("reco_cand_p4s"):
            out += [Table(f"n_cands_mode{k}", n_cands, CANDS_AXIS, where=plotted == k) for k in range(6)]
        if have("gen_jet_tau_p4", "reco_jet_p4"):
            square = Axis(bins=50, spans="true", top_of=F.greatest(vis["t"], reco["t"]))
            out.append(Table("energy_map", vis["t"], square, reco["t"], square, where=mode != -1))
    for name, (lo, hi) in IMPACT_AXES.items():
        if have(f"reco_cand_{name}"):
            out.append(Table(f"reco_cand_{name}", lambda e: F.abs(e), log_axis(lo, hi, 79), where=lambda e: e > -999, each=f"reco_cand_{name}"))
        if have(f"reco_cand_{name}_error"):
            out.append(Table(f"reco_cand_{name}_error", lambda e: e, SIGMA_AXIS, where=lambda e: e > 0, each=f"reco_cand_{name}_error"))
    if have("reco_cand_dz", "reco_cand_dxy"):
        pairs = "arrays_zip(reco_cand_dz, reco_cand_dxy)"
        out.append(Table("dz_by_dxy", lambda e: e["reco_cand_dz"], Axis(0.0, 2.0, 99), lambda e: e["reco_cand_dxy"], Axis(0.0, 10.0, 99), each=pairs))
    if have("reco_cand_p4s", "reco_jet_p4"):
        eta, phi = lambda e: reco["eta"] - e["eta"], lambda e: p4.signed_delta_phi(reco["phi"], e["phi"])
        out.append(Table("shape", eta, SHAPE_AXIS, phi, SHAPE_AXIS, weight=lambda e: e["rho"], each="reco_cand_p4s"))
        if have("gen_jet_tau_decaymode"):
            out += [Table(f"shape_mode{k}", eta, SHAPE_AXIS, phi, SHAPE_AXIS, lambda e: e["rho"], pdg.plot_mode(mode) == k, "reco_cand_p4s") for k in range(5)]
    if weight:
        out.append(Table("cls_weight", weight, Axis(*validation.WEIGHT)))
    return out
