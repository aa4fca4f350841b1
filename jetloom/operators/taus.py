"""True taus: decay products, decay modes and their jets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jetloom.functions import p4, pdg

from .filters import is_tau
from .matching import nearest_at

#: What a jet without a tau gets: decay mode, charge, visible energy, vertex (fixed values).
UNMATCHED = {"decaymode": -1, "charge": -999.0, "vis_energy": 0.0, "dv_x": -1.0, "dv_y": -1.0, "dv_z": -1.0}
#: The same for background samples, where the vertex is zero.
BACKGROUND = UNMATCHED | {"dv_x": 0.0, "dv_y": 0.0, "dv_z": 0.0}


#: How the properties of a tau are called in a jet's record.
PROPERTIES = ("vis_energy", "decaymode", "charge", "full_p4", "p4", "DV_x", "DV_y", "DV_z")
DAUGHTERS = ("vis_daughter_p4s", "vis_daughter_pdgs", "vis_daughter_charges")
_P4S = "array<struct<pt:double,eta:double,phi:double,energy:double>>"


def fill_values(signal: bool = True, daughters: bool = False) -> dict[str, Column]:
    """What a jet without a tau gets, by property."""
    values = UNMATCHED if signal else BACKGROUND
    out = {c: F.lit(values[c.lower()]) for c in PROPERTIES if not c.endswith("p4")} | {c: p4.zero_p4() for c in ("full_p4", "p4")}
    if daughters:
        out |= {c: F.array().cast(t) for c, t in zip(DAUGHTERS, (_P4S, "array<int>", "array<double>"), strict=True)}
    return out


def taus_with_daughters(mc: DataFrame) -> DataFrame:
    """One row per tau of the long particle table: full and visible four-vector, charge, decay mode and vertex, visible daughters' lists.

    ``daughters`` holds the places of a particle's daughters in its event. A tau without
    visible daughters has a zero visible four-vector and, without any, mode 15. The charge is that of the tau's code.
    """
    taus = mc.where(is_tau()).select(
        "event_id", F.col("pidx").alias("tau_id"), pdg.table_charge("pdg").cast("double").alias("charge"), F.struct("pt", "eta", "phi", "energy").alias("full_p4"),
        F.struct(F.col("dv_x").alias("DV_x"), F.col("dv_y").alias("DV_y"), F.col("dv_z").alias("DV_z")).alias("dv"),
        F.posexplode_outer("daughters").alias("place", "pidx"),
    )
    kids = mc.select("event_id", "pidx", F.col("pdg").alias("d_pdg"), "px", "py", "pz", F.col("energy").alias("d_e"), F.struct("pt", "eta", "phi", "energy").alias("d_p4"))
    both = taus.join(kids, ["event_id", "pidx"], "left")
    cand, q = pdg.candidate_id("d_pdg"), pdg.table_charge("d_pdg")
    seen = pdg.visible("d_pdg")
    n = lambda cond: F.count(F.when(cond, 1))
    sums = {c: F.coalesce(F.sum(F.when(seen, F.col(c))), F.lit(0.0)).alias("s_" + c) for c in ("px", "py", "pz", "d_e")}
    daughter = F.struct("place", "pidx", F.col("d_pdg").alias("pdg"), cand.alias("cand"), q.alias("q"), F.col("d_p4").alias("p4"))
    per = both.groupBy("event_id", "tau_id", "charge", "full_p4", "dv").agg(
        *sums.values(),
        n(cand == 211).alias("n_charged"), n(cand == 130).alias("n_neutral"), n(cand.isin(11, 13)).alias("n_lepton"),
        n(~cand.isin(*pdg.COMMON)).alias("n_other"),
        F.array_sort(F.collect_list(F.when(seen, daughter))).alias("daughters"),
    )
    vis = p4.from_cartesian("s_px", "s_py", "s_pz", energy="s_d_e")
    return per.select(
        "event_id", "tau_id", "charge", "full_p4", "dv.*",
        pdg.decay_mode("n_charged", "n_neutral", "n_lepton", "n_other").alias("decaymode"),
        vis.alias("vis_p4"), F.col("s_d_e").alias("vis_energy"), "daughters",
    )


def listed() -> Column:
    """A row of particles as the struct that ``in_lists`` reads."""
    return F.struct("pidx", "pdg", "status", "px", "py", "pz", "pt", "eta", "phi", "energy", "dv_x", "dv_y", "dv_z", "daughters")


def in_lists(mc: str, daughters: bool = False) -> Column:
    """The rows of ``properties(taus_with_daughters(...))`` of an event as a list of structs, from the list ``mc`` of its particles in order: no join.

    Structs need the fields that ``taus_with_daughters`` needs; ``daughters`` are places in the list.
    """
    four = lambda x: F.struct(*[x[c].alias(c) for c in ("pt", "eta", "phi", "energy")])
    own = F.transform(F.filter(mc, lambda x: is_tau(x["status"], x["pdg"])), lambda x: F.struct(x.alias("t"), F.filter(F.transform(x["daughters"], lambda k: F.get(F.col(mc), k)), lambda y: y.isNotNull()).alias("kids")))
    known = F.transform(own, lambda z: F.struct(z.t.alias("t"), F.transform(z.kids, lambda y: pdg.candidate_id(y["pdg"])).alias("ids"), F.filter(z.kids, lambda y: pdg.visible(y["pdg"])).alias("seen")))
    total = lambda z, c: F.aggregate(z.seen, F.lit(0.0), lambda s, y: s + y[c])
    n = lambda z, cond: F.size(F.filter(z.ids, cond))
    mode = lambda z: pdg.decay_mode(n(z, lambda i: i == 211), n(z, lambda i: i == 130), n(z, lambda i: i.isin(11, 13)), n(z, lambda i: ~i.isin(*pdg.COMMON)))
    summed = F.transform(known, lambda z: F.struct(z.t.alias("t"), z.seen.alias("seen"), mode(z).alias("mode"), *[total(z, c).alias(c) for c in ("px", "py", "pz", "energy")]))
    whole = F.transform(summed, lambda z: F.struct(z.t.alias("t"), z.seen.alias("seen"), z["mode"].alias("mode"), p4.from_cartesian(z.px, z.py, z.pz, energy=z.energy).alias("p4")))
    values = lambda z: {
        "vis_energy": z.p4["energy"], "decaymode": z["mode"], "charge": pdg.table_charge(z.t["pdg"]).cast("double"), "full_p4": four(z.t), "p4": z.p4, **{f"DV_{c}": z.t[f"dv_{c}"] for c in "xyz"},
    }
    lists = lambda z: dict(zip(DAUGHTERS, (F.transform(z.seen, four), z.seen["pdg"], F.transform(z.seen, lambda y: pdg.table_charge(y["pdg"]).cast("double"))), strict=True)) if daughters else {}
    return F.transform(whole, lambda z: F.struct(z.t["pidx"].alias("tau_id"), z.p4["eta"].alias("eta"), z.p4["phi"].alias("phi"), *[c.alias(k) for k, c in (values(z) | lists(z)).items()]))


def properties(taus: DataFrame, daughters: bool = False) -> DataFrame:
    """event_id, tau_id, eta, phi of the visible part, and the properties of each tau."""
    own = {"p4": F.col("vis_p4")}
    if daughters:
        lists = (F.col("daughters.p4"), F.col("daughters.pdg"), F.transform("daughters", lambda d: d.q.cast("double")))
        own |= dict(zip(DAUGHTERS, lists, strict=True))
    names = (*PROPERTIES, *(DAUGHTERS if daughters else ()))
    return taus.select("event_id", "tau_id", F.col("vis_p4.eta").alias("eta"), F.col("vis_p4.phi").alias("phi"), *[own.get(c, F.col(c)).alias(c) for c in names])


def jet_tau_info(jets: DataFrame, taus: DataFrame, max_dr: float = 0.4, daughters: bool = False) -> DataFrame:
    """Each jet with the properties of its tau; of several taus the last one, of none the fill values.

    Jets and taus of an event are gathered in one row and matched there: one exchange for each of the two.
    """
    seen = properties(taus, daughters).where("vis_energy != 0")
    listed = lambda df, first, name: df.groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct(first, *[c for c in df.columns if c not in ("event_id", first)]))).alias(name))
    both = listed(jets, "jet_id", "jets").join(listed(seen, "tau_id", "taus"), "event_id", "left")
    at = F.transform("taus", lambda t: nearest_at(t.eta, t.phi, "jets", max_dr, with_energy=False))
    rows = both.withColumn("at", at).select("event_id", "taus", "at", F.posexplode("jets").alias("place", "jet"))
    mine = F.filter("taus", lambda t, i: F.get(F.col("at"), i) == F.col("place"))
    rows = rows.withColumn("tau", F.get(mine, F.size(mine) - 1))
    fills = {c: v if isinstance(v, Column) else F.lit(v) for c, v in fill_values(True, daughters).items()}
    own = [F.col("event_id") if c == "event_id" else F.col(f"jet.{c}").alias(c) for c in jets.columns]
    return rows.select(*own, *[F.coalesce(F.col(f"tau.{c}"), v).alias(c) for c, v in fills.items()])


def background_info(jets: DataFrame, taus: DataFrame | None = None, max_dr: float = 0.4, daughters: bool = False) -> DataFrame:
    """The constant tau block of background jets (``taus`` is not looked at)."""
    return jets.withColumns(fill_values(False, daughters))


#: Tau information by kind of sample: signal or not.
TAU_INFO = {True: jet_tau_info, False: background_info}
