"""Track lifetime variables: point of closest approach, impact parameters, their errors and signs.

All of it is arithmetic on the long table (one row per particle with its track and its event's vertex). The closest approach is an
Arrow function of a track's numbers, the rest generated code.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jetloom.functions.p4 import col, np_div, sign_from

#: Value of every lifetime variable of a particle without a track (fixed value).
SENTINEL = -1000.0
#: Distances up to this count as zero (fixed value).
TINY = 1e-10


def origin(xr, yr, zr, d0, z0, phi) -> dict[str, Column]:
    """Point of the track that the parameters refer to."""
    return {"x0": col(xr) + F.sin(col(phi)) * col(d0), "y0": col(yr) - F.cos(col(phi)) * col(d0), "zz": col(z0) + col(zr)}


#: Columns that the closest approach is made of.
INPUTS = ("d0", "z0", "phi0", "tanl", "xr", "yr", "zr", "c_d0", "c_phi", "c_z0", "c_tan", "pvx", "pvy", "pvz")
#: A track's own numbers: those and its curvature.
TRACK = (*INPUTS[:11], "omega")
#: What it adds, each with an error.
APPROACH = ("dxy", "dz", "d3", "pca_x", "pca_y", "pca_z")


def closest_approach(d0, z0, phi0, tanl, xr, yr, zr, c_d0, c_phi, c_z0, c_tan, pvx, pvy, pvz, two_d: bool = False) -> dict[str, np.ndarray]:
    """The arc length, the point of closest approach and the distances dxy, dz, d3 of tracks, each with its error; arrays of one value a track.

    ``two_d`` leaves z out of the minimisation, not out of the position.
    """
    ux, uy = np.cos(phi0), np.sin(phi0)
    x0, y0, zz = xr + uy * d0, yr - ux * d0, z0 + zr
    e_d, e_f, e_z, e_t = (np.sqrt(np.abs(c)) for c in (c_d0, c_phi, c_z0, c_tan))
    # squared errors of the origin a and of b = a + u
    ax2 = uy * uy * e_d * e_d + ux * ux * d0 * d0 * e_f * e_f
    ay2 = ux * ux * e_d * e_d + uy * uy * d0 * d0 * e_f * e_f
    az2 = e_z * e_z
    bx2, by2, bz2 = uy * uy * e_f * e_f + ax2, ux * ux * e_f * e_f + ay2, e_t * e_t + az2
    axes = [(x0, ux, pvx, ax2, bx2), (y0, uy, pvy, ay2, by2)] + ([] if two_d else [(zz, tanl, pvz, az2, bz2)])
    add = lambda terms: sum(terms[1:], terms[0])
    num = -add([(a - v) * u for a, u, v, _, _ in axes])
    den = add([u * u for _, u, _, _, _ in axes])
    # b - a = u; the errors of numerator and denominator by the rule that this table fixes
    num_e2 = add([ea * (2 * a - (a + u) - v) ** 2 + eb * (v - (a + u)) ** 2 for a, u, v, ea, eb in axes])
    den_e2 = add([(eb + ea) * (2 * u) ** 2 for _, u, _, ea, eb in axes])
    s = num / den
    s_err = np.sqrt(num_e2 / (den * den) + num * num * den_e2 / den**4)
    out = {"s": s, "s_err": s_err, "pca_x": x0 + s * ux, "pca_y": y0 + s * uy, "pca_z": zz + s * tanl}
    ex = np.sqrt((ux * s_err) ** 2 + ax2 + (s * uy * e_f) ** 2)
    ey = np.sqrt((uy * s_err) ** 2 + ay2 + (s * ux * e_f) ** 2)
    ez = np.sqrt((tanl * s_err) ** 2 + (s * e_t) ** 2 + az2)
    dx, dy, dz = out["pca_x"] - pvx, out["pca_y"] - pvy, out["pca_z"] - pvz
    out |= {"dxy": np.sqrt(dx * dx + dy * dy), "dz": np.abs(dz), "d3": np.sqrt(dx * dx + dy * dy + dz * dz)}

    def error(total: np.ndarray, distance: np.ndarray) -> np.ndarray:
        zero = distance <= TINY
        return np.where(zero, 0.0, np.sqrt(total) / np.where(zero, 1.0, distance))

    plane = (dx * ex) ** 2 + (dy * ey) ** 2
    out |= {"pca_x_error": ex, "pca_y_error": ey, "pca_z_error": ez, "dz_error": ez}
    return out | {"dxy_error": error(plane, out["dxy"]), "d3_error": error(plane + (dz * ez) ** 2, out["d3"])}


def approach(names: dict[str, tuple[str, bool]], sentinel: bool = False) -> Column:
    """A struct of the columns ``names``: name -> (variable of ``closest_approach``, whether in two dimensions).

    One Arrow function of the tracks' numbers: as generated code these expressions make a method that is too large for the JVM to compile, so that it
    is interpreted. What depends on a NULL is NULL; with ``sentinel`` everything of a particle without d0 is the sentinel.
    """
    kind = pa.struct([(n, pa.float64()) for n in names])

    def run(*columns: pa.Array) -> pa.Array:
        values = [c.to_numpy(zero_copy_only=False) for c in columns]
        missing = np.zeros(len(columns[0]), bool)
        for c in columns:
            if c.null_count:
                missing |= c.is_null().to_numpy(zero_copy_only=False)
        absent = columns[0].is_null().to_numpy(zero_copy_only=False)
        with np.errstate(all="ignore"):
            made = {two_d: closest_approach(*values, two_d=two_d) for two_d in {d for _, d in names.values()}}
        lists = []
        for variable, two_d in names.values():
            x = made[two_d][variable]
            null = missing & np.isnan(x)
            if sentinel:
                x, null = np.where(absent, SENTINEL, x), null & ~absent
            lists.append(pa.array(x, pa.float64(), mask=null))
        return pa.StructArray.from_arrays(lists, fields=list(kind))

    return F.arrow_udf(run, "struct<" + ", ".join(f"{n}: double" for n in names) + ">")(*[F.col(c).cast("double") for c in INPUTS])


def with_closest_approach(tracks: DataFrame, two_d: bool = False, suffix: str = "") -> DataFrame:
    """Adds the arc length, the point of closest approach and the distances dxy, dz, d3, each with its error.

    Needs d0, z0, phi0, tanl, the reference point xr, yr, zr, the variances c_d0, c_phi, c_z0, c_tan and pvx, pvy, pvz.
    ``two_d`` leaves z out of the minimisation, not out of the position.
    """
    names = {f"{v}{suffix}": (v, two_d) for v in ("s", "s_err", *APPROACH, *[f"{v}_error" for v in APPROACH])}
    names = {(f"{v.removesuffix('_error')}_error{suffix}" if v.endswith("_error") else n): (v, d) for n, (v, d) in names.items()}
    made = tracks.withColumn("__made", approach(names))
    return made.withColumns({n: F.col(f"__made.{n}") for n in names}).drop("__made")


#: Lifetime variables by the names that records have -> columns of ``lifetime``.
VARIABLES = (
    {v: v for v in ("dxy", "dz", "d3", "d0", "z0", "dxy_2d", "dz_2d", "d3_2d", "pca_x", "pca_y", "pca_z")}
    | {f"vertex_{c}": f"pv{c}" for c in "xyz"}
    | {"phi0": "phi0", "tanL": "tanl", "omega": "omega"}
    | {f"{v}_error": f"{v}_error" for v in ("dxy", "dz", "d3", "d0", "z0", "pca_x", "pca_y", "pca_z")}
    | {f"{v}_2d_error": f"{v}_error_2d" for v in ("dxy", "dz", "d3")}
)
#: Those that also have a sign.
SIGNED = ("dxy", "dz", "d3", "d0", "z0", "dxy_2d", "dz_2d", "d3_2d")


def lifetime(particles: DataFrame, vertices: DataFrame) -> DataFrame:
    """Every particle with its lifetime variables in 3-D and (suffix _2d) 2-D, with ``VARIABLES``' columns.

    A particle whose track parameters are NULL has no track: all its variables are the sentinel. ``vertices`` has a row for
    every event (``sources.events`` makes one for events without a vertex too); particles of events that it lacks are left out.
    """
    names = {f"{v}{e}{'_2d' if two_d else ''}": (f"{v}{e}", two_d) for two_d in (False, True) for v in APPROACH for e in ("", "_error")}
    t = particles.join(vertices, "event_id").withColumn("__made", approach(names, sentinel=True))
    tracked = F.col("d0").isNotNull()
    rest = {"d0_error": F.sqrt(F.abs("c_d0")), "z0_error": F.sqrt(F.abs("c_z0"))} | {n: F.col(n) for n in ("z0", "phi0", "tanl", "omega", "pvx", "pvy", "pvz")}
    out = {n: F.col(f"__made.{n}") for n in names} | {n: F.when(tracked, c).otherwise(SENTINEL) for n, c in rest.items()}
    return t.withColumns(out | {"d0": F.coalesce("d0", F.lit(SENTINEL))}).drop("__made")


def in_lists(tracks: str, names: tuple[str, ...] = tuple(VARIABLES)) -> Column:
    """array<struct>: ``lifetime`` (``names`` of ``VARIABLES``) of each struct of the list ``tracks``, with the row's vertex pvx, pvy, pvz.

    One Arrow function of the lists; a track without d0 has the sentinel everywhere.
    """
    own = [c for c in INPUTS if not c.startswith("pv")]
    kind = pa.struct([(n, pa.float64()) for n in names])
    columns_ = [VARIABLES[n] for n in names]

    def run(omega: pa.Array, *columns: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(columns[0]), 0).to_numpy(zero_copy_only=False).astype(int)
        flat = [c.flatten() for c in (*columns[: len(own)], omega)]
        repeated = [np.repeat(c.to_numpy(zero_copy_only=False).astype(float), sizes) for c in columns[len(own) :]]
        values = dict(zip((*own, "omega"), (x.to_numpy(zero_copy_only=False).astype(float) for x in flat), strict=True)) | dict(zip(("pvx", "pvy", "pvz"), repeated, strict=True))
        absent = flat[0].is_null().to_numpy(zero_copy_only=False)
        gone = {n: x.is_null().to_numpy(zero_copy_only=False) for n, x in zip((*own, "omega"), flat, strict=True)}
        gone |= {n: np.repeat(c.is_null().to_numpy(zero_copy_only=False), sizes) for n, c in zip(("pvx", "pvy", "pvz"), columns[len(own) :], strict=True)}
        missing = np.logical_or.reduce([gone[c] for c in INPUTS])
        with np.errstate(all="ignore"):
            made = {two_d: closest_approach(*[values[c] for c in INPUTS], two_d=two_d) for two_d in {c.endswith("_2d") for c in columns_} | {False}}
        lists = []
        for column in columns_:
            variable, two_d = column.removesuffix("_2d"), column.endswith("_2d")
            if variable in made[two_d]:
                x = made[two_d][variable]
                null = missing & np.isnan(x)
            elif column in ("d0_error", "z0_error"):
                source = f"c_{column[:2]}"
                x, null = np.sqrt(np.abs(values[source])), gone[source]
            else:
                x, null = values[column], gone[column]
            lists.append(pa.array(np.where(absent, SENTINEL, x), pa.float64(), mask=null & ~absent))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(lists, fields=list(kind)))

    kernel = F.arrow_udf(run, "array<struct<" + ", ".join(f"{n}: double" for n in names) + ">>")
    return kernel(F.col(f"{tracks}.omega"), *[F.col(f"{tracks}.{c}") for c in own], *[F.col(c).cast("double") for c in ("pvx", "pvy", "pvz")])


def jet_signed(x: Column, name: str, jet_x, jet_y, jet_z) -> Column:
    """The signed variable ``name`` of a particle's struct (by the names of ``VARIABLES``) for a jet; all signs go by the 3-D point."""
    return signed(x[name], x["pca_x"], x["pca_y"], x["pca_z"], x["vertex_x"], x["vertex_y"], x["vertex_z"], jet_x, jet_y, jet_z)


def jet_sign(x: Column, jet_x, jet_y, jet_z) -> Column:
    """The sign that all variables of a particle's struct have for a jet."""
    return sign_along(x["pca_x"], x["pca_y"], x["pca_z"], x["vertex_x"], x["vertex_y"], x["vertex_z"], jet_x, jet_y, jet_z)


def sign_along(pca_x, pca_y, pca_z, v_x, v_y, v_z, jet_x, jet_y, jet_z) -> Column:
    """The sign of (closest point - vertex) . jet; a point on the vertex counts as along the jet."""
    d = [col(a) - col(b) for a, b in ((pca_x, v_x), (pca_y, v_y), (pca_z, v_z))]
    j = [col(x) for x in (jet_x, jet_y, jet_z)]
    size = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    along = [F.when(size <= TINY, b).otherwise(a) for a, b in zip(d, j, strict=True)]
    return sign_from(along[0] * j[0] + along[1] * j[1] + along[2] * j[2])


def signed_by(ip, sign) -> Column:
    """|ip| with a sign; the sentinel stays."""
    return F.when(col(ip) == SENTINEL, col(ip)).otherwise(col(sign) * F.abs(col(ip)))


def signed(ip, pca_x, pca_y, pca_z, v_x, v_y, v_z, jet_x, jet_y, jet_z) -> Column:
    """|ip| with the sign of (closest point - vertex) . jet; the sentinel stays; a point on the vertex counts as along the jet."""
    return signed_by(ip, sign_along(pca_x, pca_y, pca_z, v_x, v_y, v_z, jet_x, jet_y, jet_z))


def simple_impact(tracks: DataFrame) -> DataFrame:
    """Adds the archival data's dzval, dzerr, d0val, d0err, dxy, dxyerr.

    The covariance entries are used as errors themselves, the arc length's error comes from
    d0 and phi alone, and a zero distance gives NaN, as the definitions have it.
    """
    c = F.col
    sq = lambda x: x * x
    t = tracks.withColumns(origin("xr", "yr", "zr", "d0", "z0", "phi0"))
    t = t.withColumns({"ux": F.cos("phi0"), "uy": F.sin("phi0")})
    num = (c("x0") - c("pvx")) * c("ux") + (c("y0") - c("pvy")) * c("uy") + (c("zz") - c("pvz")) * c("tanl")
    t = t.withColumn("s", -num / (sq(c("ux")) + sq(c("uy")) + sq(c("tanl"))))
    t = t.withColumns({"dx": c("x0") + c("s") * c("ux") - c("pvx"), "dy": c("y0") + c("s") * c("uy") - c("pvy"), "dzs": c("zz") + c("s") * c("tanl") - c("pvz")})
    s_e2 = sq(c("c_d0")) + sq(c("c_phi"))
    x_e2 = sq(c("ux")) * s_e2 + sq(c("uy") * c("c_d0")) + sq(c("ux") * c("d0") * c("c_phi")) + sq(c("s") * c("uy") * c("c_phi"))
    y_e2 = sq(c("uy")) * s_e2 + sq(c("ux") * c("c_d0")) + sq(c("uy") * c("d0") * c("c_phi")) + sq(c("s") * c("ux") * c("c_phi"))
    z_e2 = sq(c("tanl")) * s_e2 + sq(c("s") * c("c_tan")) + sq(c("c_z0"))
    t = t.withColumns({"x_e2": x_e2, "y_e2": y_e2, "dxy": F.sqrt(sq(c("dx")) + sq(c("dy")))})
    out = {
        "dzval": F.abs("dzs"),
        "dzerr": F.sqrt(z_e2),
        "d0val": c("d0"),
        "d0err": c("c_d0"),
        "dxyerr": np_div(F.sqrt(sq(c("dx")) * c("x_e2") + sq(c("dy")) * c("y_e2")), "dxy"),
    }
    return t.withColumns(out).drop("x0", "y0", "zz", "ux", "uy", "s", "dx", "dy", "dzs", "x_e2", "y_e2")
