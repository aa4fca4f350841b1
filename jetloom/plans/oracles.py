"""The same results in SQL, written for DuckDB from the definitions (not from the Spark plans)."""

from __future__ import annotations

LI = """li AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) - 1 AS INTEGER) AS pidx FROM lineitem)"""
P0 = """p0 AS (SELECT l_orderkey AS event_id, pidx, l_extendedprice / 10000.0 AS pt, (l_quantity - 25.5) / 10.0 AS eta,
 (((l_partkey*37 + l_suppkey*11) % 360) - 180) * pi() / 180.0 AS phi,
 CASE WHEN l_linenumber <= 2 THEN CASE WHEN l_returnflag = 'R' THEN -211 ELSE 211 END WHEN l_linenumber = 3 THEN 22 WHEN l_linenumber = 4 THEN 130
  WHEN l_linenumber = 5 THEN 111 WHEN l_linenumber = 6 THEN CASE WHEN l_returnflag = 'A' THEN 11 ELSE 16 END
  ELSE CASE l_returnflag WHEN 'A' THEN 13 WHEN 'N' THEN 15 ELSE 321 END END AS pdg,
 CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS status, l_discount - 0.05 + 0.0 AS d0, l_tax - 0.04 + 0.0 AS z0, l_linenumber AS ln, l_returnflag = 'R' AS is_signal FROM li)"""
P = f"""{LI}, {P0}, p1 AS (SELECT *, CASE WHEN pdg IN (211, 321) THEN 1 WHEN pdg IN (-211, 11, 13, 15) THEN -1 ELSE 0 END AS charge,
 CAST(CASE abs(pdg) WHEN 211 THEN 0.13957 WHEN 321 THEN 0.49368 WHEN 130 THEN 0.49761 WHEN 111 THEN 0.13498 WHEN 11 THEN 0.000511 WHEN 13 THEN 0.10566 WHEN 15 THEN 1.77686 ELSE 0 END AS DOUBLE) AS mass FROM p0),
p AS (SELECT *, pt*cos(phi) AS px, pt*sin(phi) AS py, pt*sinh(eta) AS pz, sqrt(pow(pt*cosh(eta), 2) + mass*mass) AS energy, sinh(eta) AS tanl, charge*0.0006/pt AS omega,
 phi + (pidx % 3 - 1)*0.01 AS phi0, (pidx*3 % 5 - 2)/1000.0 AS xr, (pidx*5 % 7 - 3)/1000.0 AS yr, (pidx*7 % 11 - 5)/100.0 AS zr, charge <> 0 AND pidx % 7 <> 6 AS trk, CAST(count(*) OVER (PARTITION BY event_id) AS INTEGER) AS np,
 pow(0.001*ln, 2) AS c0, pow(0.0005*ln, 2) AS c2, pow(0.002*ln, 2) AS c9, pow(0.0004*ln, 2) AS c14 FROM p1)"""
V = "v AS (SELECT o_orderkey AS event_id, ((o_custkey % 7) - 3) / 1000.0 AS vx, ((o_custkey % 5) - 2) / 1000.0 AS vy, ((o_custkey % 11) - 5) / 100.0 AS vz FROM orders)"
G = "g AS (SELECT event_id, pidx, pdg, pt*1.02 AS pt, eta + z0 AS eta, phi + d0 AS phi FROM p WHERE status = 1 AND abs(pdg) NOT IN (12, 14, 16))"
J = "j AS (SELECT event_id, pidx AS jet_id, pt, eta, phi, energy FROM p WHERE pidx < 2)"
S = """s AS (SELECT event_id, sum(px) AS jx, sum(py) AS jy, sum(pz) AS jz, sum(energy) AS je, count(*) AS n FROM p GROUP BY event_id),
e AS (SELECT p.*, jx, jy, jz, je, n, sqrt(jx*jx + jy*jy) AS jpt, asinh(jz / sqrt(jx*jx + jy*jy)) AS jeta, atan2(jy, jx) AS jphi FROM p JOIN s USING (event_id))"""


def dphi(a: str, b: str) -> str:
    return f"atan2(sin({a} - {b}), cos({a} - {b}))"


def dr(ea: str, pa: str, eb: str, pb: str) -> str:
    return f"sqrt(pow({ea} - {eb}, 2) + pow({dphi(pa, pb)}, 2))"


def rnd(x: str, name: str | None = None, n: int = 6) -> str:
    return f"round({x}, {n}) + 0.0 AS {name or x}"


def th(eta: str) -> str:
    return f"2*atan(exp(-({eta})))"


def ubin(x: str, lo: float, hi: float, n: int) -> str:
    """Bin of equal width, last one closed."""
    edge = f"list_transform(range(0, {n} + 1), lambda i: {lo}e0 + i*{(hi - lo) / n!r}e0)"
    return f"CASE WHEN {x} < {lo} THEN -1 WHEN {x} > {hi} THEN {n} WHEN {x} = {hi} THEN {n - 1} ELSE len(list_filter({edge}, lambda q: q <= {x})) - 1 END"


MATCH = f"""pairs AS (SELECT a.event_id, a.pidx AS left_id, g.pidx AS right_id, {dr('a.eta', 'a.phi', 'g.eta', 'g.phi')} AS dr FROM p a JOIN g USING (event_id)),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id, left_id ORDER BY dr, right_id) AS k FROM pairs) WHERE k = 1 AND dr < 0.4)"""
ASSIGN = f"""ap AS (SELECT p.event_id, p.pidx, j.jet_id, {dr('p.eta', 'p.phi', 'j.eta', 'j.phi')} AS dr FROM p JOIN j USING (event_id)),
am AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id, pidx ORDER BY dr, jet_id) AS k FROM ap) WHERE k = 1 AND dr <= 0.8)"""
CAND = "CASE WHEN abs(d.pdg) IN (211, 321) THEN 211 WHEN abs(d.pdg) IN (130, 111) THEN 130 ELSE abs(d.pdg) END"
TAUS = f"""t AS (SELECT *, greatest(pidx - 3, 0) AS b0, pidx AS b1 FROM p WHERE abs(pdg) = 15 AND status = 2),
tk AS (SELECT t.*, k, (k + np - 1) % np AS d FROM t, range(0, 40) r(k) WHERE k >= b0 AND k < b1),
td AS (SELECT t.event_id, t.pidx AS tau_id, t.k, d.pidx AS d_id, d.pdg AS d_pdg, {CAND} AS cand, d.charge AS q, d.px, d.py, d.pz, d.energy, d.pdg NOT IN (12, 14, 16, -12, -14, -16) AS seen
 FROM tk t JOIN p d ON d.event_id = t.event_id AND d.pidx = t.d),
tt AS (SELECT t.event_id, t.pidx AS tau_id, CAST(t.charge AS DOUBLE) AS charge, t.pt AS full_pt, t.energy AS full_e, string_agg(CAST(d_pdg AS VARCHAR), ',' ORDER BY k) FILTER (seen) AS seen_pdgs, count(*) FILTER (cand = 211) AS n211, count(*) FILTER (cand = 130) AS n130, count(*) FILTER (cand IN (11, 13)) AS nlep,
 count(*) FILTER (cand NOT IN (16, 130, 211, 13, 14, 12, 11)) AS nodd, coalesce(sum(td.px) FILTER (seen), 0) AS sx, coalesce(sum(td.py) FILTER (seen), 0) AS sy, coalesce(sum(td.pz) FILTER (seen), 0) AS sz, coalesce(sum(td.energy) FILTER (seen), 0) AS se
 FROM t LEFT JOIN td ON td.event_id = t.event_id AND td.tau_id = t.pidx GROUP BY ALL),
tm AS (SELECT *, CAST(CASE WHEN nodd > 0 THEN 15 WHEN n211 BETWEEN 1 AND 3 THEN 5*(n211 - 1) + least(n130, 4) WHEN nlep > 0 THEN 16 ELSE 15 END AS INTEGER) AS decaymode FROM tt)"""


def life(two_d: bool, rows: str = "p JOIN v USING (event_id)") -> str:
    s = "_2d" if two_d else ""
    z = "0" if two_d else "1"
    return f"""o{s} AS (SELECT event_id, pidx, charge, trk, pdg, vx, vy, vz, tanl, phi0, omega, z0, cos(phi0) AS ux, sin(phi0) AS uy, tanl AS uz, xr + sin(phi0)*d0 AS x0, yr - cos(phi0)*d0 AS y0, z0 + zr AS zz,
 sqrt(c0) AS ed, sqrt(c2) AS ef, sqrt(c9) AS ez, sqrt(c14) AS et, d0 FROM {rows}),
o1{s} AS (SELECT *, uy*uy*ed*ed + ux*ux*d0*d0*ef*ef AS ax, ux*ux*ed*ed + uy*uy*d0*d0*ef*ef AS ay, ez*ez AS az FROM o{s}),
o2{s} AS (SELECT *, uy*uy*ef*ef + ax AS bx, ux*ux*ef*ef + ay AS bby, et*et + az AS bz, -((x0 - vx)*ux + (y0 - vy)*uy + {z}*(zz - vz)*uz) AS num, ux*ux + uy*uy + {z}*uz*uz AS den FROM o1{s}),
o3{s} AS (SELECT *, num/den AS s, ax*pow(2*x0 - (x0 + ux) - vx, 2) + bx*pow(vx - (x0 + ux), 2) + ay*pow(2*y0 - (y0 + uy) - vy, 2) + bby*pow(vy - (y0 + uy), 2)
   + {z}*(az*pow(2*zz - (zz + uz) - vz, 2) + bz*pow(vz - (zz + uz), 2)) AS ne2, (bx + ax)*4*ux*ux + (bby + ay)*4*uy*uy + {z}*(bz + az)*4*uz*uz AS de2 FROM o2{s}),
o4{s} AS (SELECT *, sqrt(ne2/(den*den) + num*num*de2/pow(den, 4)) AS se, x0 + s*ux AS qx, y0 + s*uy AS qy, zz + s*tanl AS qz FROM o3{s}),
o5{s} AS (SELECT *, sqrt(pow(ux*se, 2) + ax + pow(s*uy*ef, 2)) AS ex, sqrt(pow(uy*se, 2) + ay + pow(s*ux*ef, 2)) AS ey, sqrt(pow(tanl*se, 2) + pow(s*et, 2) + az) AS ezz,
 qx - vx AS dx, qy - vy AS dy, qz - vz AS dz0 FROM o4{s}),
l{s} AS (SELECT event_id, pidx, charge, trk, d0, z0, ed AS d0_error, ez AS z0_error, phi0, tanl, omega, qx AS pca_x{s}, qy AS pca_y{s}, qz AS pca_z{s}, vx, vy, vz, sqrt(dx*dx + dy*dy) AS dxy{s}, abs(dz0) AS dz{s}, sqrt(dx*dx + dy*dy + dz0*dz0) AS d3{s},
 ex AS pca_x_error{s}, ey AS pca_y_error{s}, ezz AS pca_z_error{s}, ezz AS dz_error{s},
 CASE WHEN sqrt(dx*dx + dy*dy) > 1e-10 THEN sqrt(pow(dx*ex, 2) + pow(dy*ey, 2)) / sqrt(dx*dx + dy*dy) ELSE 0 END AS dxy_error{s},
 CASE WHEN sqrt(dx*dx + dy*dy + dz0*dz0) > 1e-10 THEN sqrt(pow(dx*ex, 2) + pow(dy*ey, 2) + pow(dz0*ezz, 2)) / sqrt(dx*dx + dy*dy + dz0*dz0) ELSE 0 END AS d3_error{s} FROM o5{s})"""


def or_sentinel(names: list[str], as_name: dict[str, str] = {}, digits: int = 6) -> str:  # noqa: B006
    return ", ".join(rnd(f"CASE WHEN trk THEN {n} ELSE -1000.0 END", as_name.get(n, n), digits) for n in names)


LIFE = f"WITH {P}, {V}, {life(False)}"
LIFE2 = f"WITH {P}, {V}, {life(True)}"


def wmat() -> str:
    y, x = ubin("theta_deg", 10.0, 170.0, 40), ubin("pp", 2.0, 55.0, 52)
    frac = lambda cond, n: f"{n} AS (SELECT tb, pb, count(*) / sum(count(*)) OVER () AS f FROM wb WHERE {cond} AND tb BETWEEN 0 AND 39 AND pb BETWEEN 0 AND 51 GROUP BY tb, pb)"
    return f"""wa AS (SELECT *, degrees({th('eta')}) AS theta_deg, pt*cosh(eta) AS pp FROM p), wb AS (SELECT {y} AS tb, {x} AS pb, is_signal FROM wa),
{frac('is_signal', 'wt')}, {frac('NOT is_signal', 'wo')}, wm AS (SELECT tb, pb, least(wt.f, coalesce(wo.f, 0)) / wt.f AS weight FROM wt LEFT JOIN wo USING (tb, pb))"""


def cbin(x: str, lo: float, hi: float, n: int) -> str:
    h = (hi - lo) / n / 2
    cs = f"list_transform(range(0, {n}), lambda i: {lo + h!r}e0 + i*{((hi - h) - (lo + h)) / (n - 1)!r}e0)"
    return f"CAST(greatest(0, least({n - 1}, len(list_filter({cs}, lambda q: q <= {x})) - 1)) AS INTEGER)"


WAPPLY = f"wx AS (SELECT *, {cbin('theta_deg', 10.0, 170.0, 40)} AS theta_bin, {cbin('pp', 2.0, 55.0, 52)} AS p_bin FROM wa), wy AS (SELECT wx.*, coalesce(weight, 0.0) AS cls_weight FROM wx LEFT JOIN wm ON tb = theta_bin AND pb = p_bin)"
SIG = """sg AS (SELECT event_id, coalesce(string_agg(CAST(abs(pdg) AS VARCHAR), ' ' ORDER BY abs(pdg)) FILTER (pidx < 2), '') AS gen_sig,
 coalesce(string_agg(CAST(abs(pdg) AS VARCHAR), ' ' ORDER BY abs(pdg)) FILTER (pidx >= 2), '') AS reco_sig FROM p GROUP BY event_id)"""
EIG = """m0 AS (SELECT event_id, sum(px*px) xx, sum(py*py) yy, sum(pz*pz) zz, sum(px*py) xy, sum(px*pz) xz, sum(py*pz) yz FROM p GROUP BY event_id),
m1 AS (SELECT event_id, xx/(xx+yy+zz) xx, yy/(xx+yy+zz) yy, zz/(xx+yy+zz) zz, xy/(xx+yy+zz) xy, xz/(xx+yy+zz) xz, yz/(xx+yy+zz) yz FROM m0),
m2 AS (SELECT *, (xx+yy+zz)/3 AS q, xy*xy + xz*xz + yz*yz AS off FROM m1), m3 AS (SELECT *, sqrt((pow(xx-q,2) + pow(yy-q,2) + pow(zz-q,2) + 2*off)/6) AS s FROM m2),
m4 AS (SELECT *, CASE WHEN s = 0 THEN 0 ELSE greatest(-1, least(1, ((xx-q)*((yy-q)*(zz-q) - yz*yz) - xy*(xy*(zz-q) - yz*xz) + xz*(xy*yz - (yy-q)*xz)) / (2*s*s*s))) END AS r FROM m3),
m5 AS (SELECT event_id, q + 2*s*cos(acos(r)/3) AS l3, q + 2*s*cos(acos(r)/3 + 2*pi()/3) AS l1, 3*q AS tr FROM m4)"""


def hist(source: str, x: str, lo: float, hi: float, n: int, key: str = "") -> str:
    k = f"{key}, " if key else ""
    frame = f"(SELECT DISTINCT {key} FROM {source}) k CROSS JOIN " if key else ""
    on = f"k.{key} = h.{key} AND " if key else ""
    sel = f"k.{key}, " if key else ""
    return f"SELECT {sel}CAST(b.i AS INTEGER) AS bin, coalesce(h.c, 0.0) AS value FROM {frame}range(0, {n}) b(i) LEFT JOIN (SELECT {k}{ubin(x, lo, hi, n)} AS bin, CAST(count(*) AS DOUBLE) AS c FROM {source} GROUP BY ALL) h ON {on}h.bin = b.i"


def hist_list(source: str, x: str, edges: list[float], key: str) -> str:
    """Counts between any edges, the last one closed."""
    n, es = len(edges) - 1, "[" + ", ".join(f"{e!r}::DOUBLE" for e in edges) + "]"
    bin_ = f"CASE WHEN {x} = {edges[-1]!r} THEN {n - 1} ELSE len(list_filter({es}, lambda q: q <= {x})) - 1 END"
    return f"SELECT k.{key}, CAST(b.i AS INTEGER) AS bin, coalesce(h.c, 0.0) AS value FROM (SELECT DISTINCT {key} FROM {source}) k CROSS JOIN range(0, {n}) b(i) LEFT JOIN (SELECT {key}, {bin_} AS bin, CAST(count(*) AS DOUBLE) AS c FROM {source} GROUP BY ALL) h ON h.{key} = k.{key} AND h.bin = b.i"


def jets(radius: float, source: str = "p", tag: str = "") -> str:
    """Inclusive jets: each step of an event's list merges the closest pair or, if that is farther than the beam, ends the softest-weighted object."""
    scale = f"(1 - cos({radius}::DOUBLE))"
    weight = "1/(l[{0}].e*l[{0}].e)"
    unit = "(l[a].x*l[b].x + l[a].y*l[b].y + l[a].z*l[b].z)/(sqrt(l[a].x*l[a].x + l[a].y*l[a].y + l[a].z*l[a].z)*sqrt(l[b].x*l[b].x + l[b].y*l[b].y + l[b].z*l[b].z))"
    pairs = f"flatten(list_transform(range(1, len(l)), lambda a: list_transform(range(a + 1, len(l) + 1), lambda b: {{'d': least({weight.format('a')}, {weight.format('b')})*(1 - greatest(-1, least(1, {unit})))/{scale}, 'a': a, 'b': b}})))"
    beams = f"list_transform(range(1, len(l) + 1), lambda a: {{'w': {weight.format('a')}, 'a': a}})"
    without = lambda gone: f"list_transform(list_filter(range(1, len(l) + 1), lambda i: i NOT IN ({gone})), lambda i: l[i])"
    both = ", ".join(f"'{c}': l[p.a].{c} + l[p.b].{c}" for c in ("e", "x", "y", "z"))
    return f"""s0{tag} AS (SELECT event_id, list({{'e': energy, 'x': px, 'y': py, 'z': pz, 'm': [pidx]}} ORDER BY pidx) AS l FROM {source} GROUP BY event_id),
st{tag} AS (SELECT event_id, l, CAST(NULL AS STRUCT(e DOUBLE, x DOUBLE, y DOUBLE, z DOUBLE, m INTEGER[])) AS jet FROM s0{tag} UNION ALL
 SELECT event_id, CASE WHEN p.d <= q.w THEN list_append({without('p.a, p.b')}, {{{both}, 'm': list_concat(l[p.a].m, l[p.b].m)}}) ELSE {without('q.a')} END, CASE WHEN p.d <= q.w THEN NULL ELSE l[q.a] END
 FROM (SELECT event_id, l, list_sort({pairs})[1] AS p, list_sort({beams})[1] AS q FROM st{tag} WHERE len(l) > 0)),
jt{tag} AS (SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY jet.e DESC, list_min(jet.m)) - 1 AS INTEGER) AS jet_id, jet.x AS px, jet.y AS py, jet.z AS pz, jet.e AS energy, list_sort(jet.m) AS m FROM st{tag} WHERE jet IS NOT NULL)"""


def thrust() -> str:
    """Per event the axis is moved until it stays, from the total momentum on, 100 times at most."""
    dot = "(xs[j]*nx + ys[j]*ny + zs[j]*nz)"
    turned = lambda c: f"list_sum(list_transform(range(1, len(xs) + 1), lambda j: sign({dot})*{c}s[j]))"
    near = " AND ".join(f"abs(n{c}/m - o{c}) <= 1e-8 + 1e-5*abs(o{c})" for c in "xyz")
    return f"""e0 AS (SELECT event_id, list(px) AS xs, list(py) AS ys, list(pz) AS zs, sum(px) AS sx, sum(py) AS sy, sum(pz) AS sz, sqrt(pow(sum(px), 2) + pow(sum(py), 2) + pow(sum(pz), 2)) AS s FROM p GROUP BY event_id),
ax AS (SELECT event_id, 0 AS k, false AS done, xs, ys, zs, sx/s AS nx, sy/s AS ny, sz/s AS nz FROM e0 UNION ALL
 SELECT event_id, k + 1, {near}, xs, ys, zs, {', '.join(f"CASE WHEN {near} THEN o{c} ELSE n{c}/m END" for c in 'xyz')}
 FROM (SELECT *, sqrt(nx*nx + ny*ny + nz*nz) AS m FROM (SELECT event_id, k, xs, ys, zs, nx AS ox, ny AS oy, nz AS oz, {', '.join(f"{turned(c)} AS n{c}" for c in 'xyz')} FROM ax WHERE NOT done AND k < 100))),
th AS (SELECT event_id, list_sum(list_transform(range(1, len(xs) + 1), lambda j: abs({dot})))/list_sum(list_transform(range(1, len(xs) + 1), lambda j: sqrt(xs[j]*xs[j] + ys[j]*ys[j] + zs[j]*zs[j]))) AS thrust
 FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY k DESC) AS last FROM ax) WHERE last = 1)"""


#: Column of ``b`` -> name of a lifetime variable in records.
VARIABLES = {v: v for v in ("dxy", "dz", "d3", "d0", "z0", "dxy_2d", "dz_2d", "d3_2d", "pca_x", "pca_y", "pca_z", "phi0", "omega")}
VARIABLES |= {"tanl": "tanL", "vx": "vertex_x", "vy": "vertex_y", "vz": "vertex_z"} | {f"{v}_error": f"{v}_error" for v in ("dxy", "dz", "d3", "d0", "z0", "pca_x", "pca_y", "pca_z")}
VARIABLES |= {f"{v}_error_2d": f"{v}_2d_error" for v in ("dxy", "dz", "d3")}


def archival() -> str:
    """Archival particles: single-precision tracks, padded vertices, the closest approach."""
    return f"""{P}, {V}, f AS (SELECT * REPLACE ({', '.join(f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}" for c in ('d0', 'z0', 'phi0', 'tanl', 'c0', 'c2', 'c9', 'c14'))}, CASE WHEN event_id % 9 = 0 THEN -999.9 ELSE vx END AS vx, CASE WHEN event_id % 9 = 0 THEN -999.9 ELSE vy END AS vy, CASE WHEN event_id % 9 = 0 THEN -999.9 ELSE vz END AS vz) FROM p JOIN v USING (event_id)),
 a AS (SELECT *, cos(phi0) AS ux, sin(phi0) AS uy, xr + sin(phi0)*d0 AS x0, yr - cos(phi0)*d0 AS y0, z0 + zr AS zz FROM f),
 b AS (SELECT *, -((x0 - vx)*ux + (y0 - vy)*uy + (zz - vz)*tanl)/(ux*ux + uy*uy + tanl*tanl) AS s, c0*c0 + c2*c2 AS se2 FROM a)"""


def _permuted(particles: str, key: str, seed: int = 42, rounds: int = 6) -> str:
    """Rounds of the bijection one after another, again for those that are not below n."""

    def mixed(x: str, k: int) -> str:
        one = f"(({x} % 2147483647) * 48271 + {(k + 1) * 69621 + seed * 39373 % 2147483647}) % 2147483647"
        two = f"(({one}) * 16807 + (({one}) >> 11)) % 2147483647"
        return f"(({two}) * 40692 + (({two}) >> 13)) % 2147483647"

    def once(rel: str) -> str:
        sql = f"SELECT id, x // b AS l, x % b AS r, a, b, n FROM {rel}"
        for k in range(rounds):
            sql = f"SELECT id, l, (r + {mixed('l', k)}) % b AS r, a, b, n FROM ({sql})" if k % 2 else f"SELECT id, (l + {mixed('r', k)}) % a AS l, r, a, b, n FROM ({sql})"
        return f"SELECT id, l * b + r AS x, a, b, n FROM ({sql})"

    return f"""WITH RECURSIVE {particles}, k AS (SELECT event_id, pidx, {key} AS key FROM p), t AS (SELECT event_id, pidx, row_number() OVER (ORDER BY key, event_id, pidx) - 1 AS id FROM k),
s AS (SELECT n, CAST(floor(sqrt(n - 1)) AS BIGINT) + 1 AS a, CAST(ceil(n / (CAST(floor(sqrt(n - 1)) AS BIGINT) + 1)) AS BIGINT) AS b FROM (SELECT count(*) AS n FROM p)),
w AS ({once('(SELECT id, id AS x, a, b, n FROM t, s)')} UNION ALL {once('(SELECT * FROM w WHERE x >= n)')})
SELECT event_id, pidx, x AS place, CAST(x * 8 // n AS INTEGER) AS file FROM w JOIN t USING (id) WHERE x < n"""


def codes(text: str) -> str:
    return f"CASE WHEN {text} = '' THEN [] ELSE CAST(string_split({text}, ' ') AS INTEGER[]) END"


def labels(text: str) -> str:
    names = {211: "charged hadron", 321: "charged kaon", 130: "neutral hadron", 111: "neutral pion", 22: "photon", 11: "electron", 13: "muon", 15: "tau"}
    name = "CASE x " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in names.items()) + " ELSE 'invisible' END"
    return f"array_to_string(list_transform({codes(text)}, lambda x: {name}), ', ')"


def _one_scan() -> str:
    """Each validation table as a query of its own over jets (j) and their candidates (c); ends of axes from the row e."""
    edges = lambda lo, hi, n: f"list_transform(range(0, {n} + 1), lambda i: {lo} + i*(({hi} - {lo})/{n}))"
    powers = lambda lo, hi, n: f"list_transform({edges(lo, hi, n)}, lambda q: pow(10.0, q))"

    def place(x: str, axis: tuple) -> str:
        kind, lo, hi, n = axis[:4]
        lo, hi = (f"{v}e0" if isinstance(v, float) else v for v in (lo, hi))
        all_edges, first, last = edges(lo, hi, n), lo, hi
        if kind in ("log", "span log"):
            a, b = (lo, hi) if kind == "log" else (f"log10({lo})", f"log10({hi})")
            all_edges, first, last = powers(a, b, n), *((f"pow(10.0, {lo})", f"pow(10.0, {hi})") if kind == "log" else (lo, hi))
        inside = f"CASE WHEN {x} = {last} THEN {n - 1} ELSE greatest(0, least({n - 1}, len(list_filter({all_edges}, lambda q: q <= {x})) - 1)) END"
        return inside if axis[4:] == ("sum",) else f"CASE WHEN {x} >= {first} AND {x} <= {last} THEN {inside} END"

    span = lambda v: ("span", f"e.lo_{v}", f"e.hi_{v}", 50)
    square = ("span", "0e0", "e.top", 50)
    mode = "CASE WHEN mode IN (0, 1) THEN mode WHEN mode BETWEEN 2 AND 4 THEN 2 WHEN mode = 10 THEN 3 WHEN mode BETWEEN 11 AND 14 THEN 4 WHEN mode BETWEEN 5 AND 9 OR mode = 15 THEN 5 ELSE -1 END"
    shape = (-1.95, 2.05)
    tables = [(f"gen_jet_{v}", "j", v, span(v), None, None, "w", "true") for v in ("pt", "eta", "theta", "p", "mass")]
    tables += [("n_cands", "j", "n", span("n"), None, None, "w", "true"), ("n_particles", "j", "n", ("u", 0.0, 50.0, 50), None, None, "1.0", "true")]
    tables += [("reco_jet_pt", "j", "pt", ("u", 0.0, 220.0, 50, "sum"), None, None, "1.0", "true"), ("reco_jet_mass", "j", "mass", ("u", 0.0, 10.0, 50), None, None, "1.0", "true")]
    tables += [("n_cands_by_pt", "j", "n", ("u", 0.0, 50.0, 50), "pt", ("span log", "e.lo_apt", "e.hi_apt", 50), "1.0", "true"), ("decaymode", "j", "mode", ("u", 0.0, 16.0, 16), None, None, "1.0", "true")]
    tables += [(f"n_cands_mode{k}", "j", "n", ("u", 1.0, 11.0, 10), None, None, "1.0", f"({mode}) = {k}") for k in range(6)]
    tables.append(("energy_map", "j", "energy*0.45", square, "energy", square, "1.0", "mode <> -1"))
    for name, hi in (("dxy", 1.0), ("dz", 1.0), ("d3", 2.0)):
        tables += [(f"reco_cand_{name}", "c", f"abs({name})", ("log", -3.0, hi, 79), None, None, "1.0", "trk"), (f"reco_cand_{name}_error", "c", f"{name}_error", ("log", -4.0, 0.0, 79), None, None, "1.0", f"trk AND {name}_error > 0")]
    tables.append(("dz_by_dxy", "c", "dz", ("u", 0.0, 2.0, 99), "dxy", ("u", 0.0, 10.0, 99), "1.0", "trk"))
    both = ("jeta - eta", ("u", *shape, 20), dphi("jphi", "phi"), ("u", *shape, 20), "cpt")
    tables += [("shape", "c", *both, "true"), *[(f"shape_mode{k}", "c", *both, f"({mode}) = {k}") for k in range(5)], ("cls_weight", "j", "w", ("u", 0.0, 1.0, 50), None, None, "1.0", "true")]
    parts = []
    for name, rel, x, xa, y, ya, w, cond in tables:
        q = f"SELECT is_signal, CAST({place('x', xa)} AS INTEGER) AS x_bin, CAST({place('y', ya) if ya else 'NULL'} AS INTEGER) AS y_bin, w FROM (SELECT is_signal, CAST({x} AS DOUBLE) AS x, CAST({y or 0} AS DOUBLE) AS y, {w} AS w FROM {rel} WHERE {cond}), e"
        parts.append(f"SELECT is_signal, '{name}' AS name, x_bin, y_bin, count(*) AS n, {rnd('sum(w)', 'value', 4)} FROM ({q}) WHERE x_bin IS NOT NULL{' AND y_bin IS NOT NULL' if ya else ''} GROUP BY is_signal, x_bin, y_bin")
    ends = ", ".join(f"min({v}) FILTER (NOT is_signal) AS lo_{v}, max({v}) FILTER (NOT is_signal) AS hi_{v}" for v in ("pt", "eta", "theta", "p", "mass", "n"))
    return f"""{LIFE}, {TAUS}, f AS (SELECT event_id, min(decaymode) AS m FROM tm GROUP BY event_id),
j0 AS (SELECT event_id, bool_or(is_signal) AS is_signal, sum(px) AS jx, sum(py) AS jy, sum(pz) AS jz, sum(energy) AS energy, CAST(count(*) AS DOUBLE) AS n FROM p GROUP BY event_id),
j1 AS (SELECT j0.*, sqrt(jx*jx + jy*jy) AS pt, asinh(jz / sqrt(jx*jx + jy*jy)) AS eta, atan2(jy, jx) AS phi, coalesce(m, -1) AS mode, (event_id % 7 + 1) / 8.0 AS w FROM j0 LEFT JOIN f USING (event_id)),
j AS (SELECT *, degrees({th('eta')}) AS theta, pt*cosh(eta) AS p, sqrt(greatest(energy*energy - pow(pt*cosh(eta), 2), 0)) AS mass FROM j1),
c AS (SELECT j.is_signal, j.mode, j.eta AS jeta, j.phi AS jphi, p.pt AS cpt, p.eta, p.phi, l.trk, l.dxy, l.dz, l.d3, l.dxy_error, l.dz_error, l.d3_error FROM l JOIN p USING (event_id, pidx) JOIN j USING (event_id)),
e AS (SELECT {ends}, min(pt) AS lo_apt, max(pt) AS hi_apt, max(greatest(energy, energy*0.45)) FILTER (mode <> -1) AS top FROM j)
{' UNION ALL '.join(parts)}"""


def oracle_sql() -> dict[str, str]:
    seed = "(((((42*31 + event_id) * 2654435 + 12345) % 4294967296) * 31 + pidx) * 2654435 + 12345) % 4294967296"
    n_of = lambda *c: f"count(*) FILTER (abs(pdg) IN ({', '.join(map(str, c))}))"
    found = {
        "p4_kinematics": f"WITH {P} SELECT event_id, pidx, {rnd('pt')}, {rnd('eta')}, {rnd('phi')}, {rnd('energy')}, {rnd('pt*cosh(eta)', 'p')}, {rnd('degrees(' + th('eta') + ')', 'theta_deg')}, {rnd('mass', n=4)} FROM p".replace("round(phi, 6)", "round(atan2(py, px), 6)"),
        "angular_features": f"""WITH {P} SELECT a.event_id, a.pidx, b.pidx AS b_pidx, {rnd('abs(' + dphi('a.phi', 'b.phi') + ')', 'dphi')}, {rnd('cos(a.phi - b.phi)', 'cos_dphi')}, {rnd('abs(a.eta - b.eta)', 'deta')},
 {rnd(f'abs({th("a.eta")} - {th("b.eta")})', 'dtheta')}, {rnd(dr('a.eta', 'a.phi', 'b.eta', 'b.phi'), 'dr')}, {rnd(f'sqrt(pow({th("a.eta")} - {th("b.eta")}, 2) + pow({dphi("a.phi", "b.phi")}, 2))', 'dr_theta')},
 {rnd('acos(greatest(-1.0, least(1.0, (a.px*b.px + a.py*b.py + a.pz*b.pz) / sqrt((a.px*a.px + a.py*a.py + a.pz*a.pz)*(b.px*b.px + b.py*b.py + b.pz*b.pz)))))', 'angle', 5)}
 FROM p a JOIN p b ON a.event_id = b.event_id AND a.pidx < b.pidx""",
        "mc_stable_visible": f"WITH {P} SELECT event_id, pidx, pdg, {rnd('pt')} FROM p WHERE status = 1 AND abs(pdg) NOT IN (12, 14, 16)",
        "lepton_veto_events": f"WITH {P} SELECT event_id, NOT bool_or(abs(pdg) IN (13, 15)) AS gen_kept, NOT bool_or(abs(pdg) IN (11, 13)) AS reco_kept FROM p GROUP BY event_id",
        "quality_filtered_events": f"WITH {P} SELECT event_id FROM p GROUP BY event_id HAVING NOT bool_or(pt <= 0 OR energy >= 45.6 OR pt = -999.9) AND NOT bool_or(pidx < 2 AND (pt < 0 OR energy > 91.2))",
        "archival_jet_filter": f"""WITH {P}, {J}, {ASSIGN} SELECT j.event_id, j.jet_id, count(p.pidx) AS n_particles FROM j LEFT JOIN am ON am.event_id = j.event_id AND am.jet_id = j.jet_id
 LEFT JOIN p ON p.event_id = am.event_id AND p.pidx = am.pidx WHERE j.pt > 0 AND j.energy <= 91.2 GROUP BY ALL HAVING NOT coalesce(bool_or(p.pt <= 0 OR p.energy >= 45.6), false)""",
        "nearest_match": f"WITH {P}, {G}, {MATCH} SELECT event_id, left_id, right_id, {rnd('dr')} FROM m",
        "tau_truth": f"WITH {P}, {TAUS} SELECT event_id, tau_id, charge, decaymode, {rnd('se', 'vis_energy')}, {rnd('sqrt(sx*sx + sy*sy)', 'vis_pt')}, {rnd('full_pt')} FROM tm",
        "tau_daughters": f"""WITH {P}, {TAUS} SELECT t.event_id, t.pidx AS tau_id, coalesce(string_agg(CAST(d_id AS VARCHAR), ',' ORDER BY k) FILTER (seen), '') AS daughters,
 coalesce(string_agg(CAST(cand AS VARCHAR), ',' ORDER BY k) FILTER (seen), '') AS candidates, coalesce(string_agg(CAST(q AS VARCHAR), ',' ORDER BY k) FILTER (seen), '') AS charges
 FROM t LEFT JOIN td ON td.event_id = t.event_id AND td.tau_id = t.pidx GROUP BY ALL""",
        "tau_to_jet_left_fill": f"""WITH {P}, {G}, {TAUS}, vt AS (SELECT *, asinh(sz/sqrt(sx*sx + sy*sy)) AS teta, atan2(sy, sx) AS tphi FROM tm WHERE se <> 0),
 c AS (SELECT vt.event_id, tau_id, g.pidx AS jet_id, {dr('teta', 'tphi', 'g.eta', 'g.phi')} AS dr FROM vt JOIN g USING (event_id)),
 c1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id, tau_id ORDER BY dr, jet_id) k FROM c) WHERE k = 1 AND dr < 0.4),
 c2 AS (SELECT event_id, jet_id, max(tau_id) AS tau_id FROM c1 GROUP BY ALL)
 SELECT g.event_id, g.pidx AS jet_id, coalesce(decaymode, -1) AS decaymode, coalesce(charge, -999.0) AS charge, {rnd('coalesce(se, 0.0)', 'vis_energy')}, {rnd('coalesce(sqrt(sx*sx + sy*sy), 0.0)', 'vis_pt')}, {rnd('coalesce(full_e, 0.0)', 'full_energy')},
 {rnd('coalesce(c2.tau_id/100.0, -1.0)', 'dv_x')}, {rnd('coalesce(c2.tau_id % 3/50.0, -1.0)', 'dv_y')}, {rnd('coalesce(-c2.tau_id/200.0, -1.0)', 'dv_z')}, coalesce(seen_pdgs, '') AS daughter_pdgs FROM g LEFT JOIN c2 ON c2.event_id = g.event_id AND c2.jet_id = g.pidx LEFT JOIN tm ON tm.event_id = c2.event_id AND tm.tau_id = c2.tau_id""",
        "background_tau_block": f"WITH {P}, {J} SELECT event_id, jet_id, -1 AS gen_jet_tau_decaymode, CAST(-999.0 AS DOUBLE) AS gen_jet_tau_charge, CAST(0 AS DOUBLE) AS gen_jet_tau_vis_energy, CAST(0 AS DOUBLE) AS gen_jet_tau_dv_x, CAST(0 AS DOUBLE) AS tau_pt, CAST(0 AS BIGINT) AS n_daughters FROM j",
        "particle_to_jet_assign": f"WITH {P}, {J}, {ASSIGN} SELECT j.event_id, j.jet_id, count(am.pidx) AS n_particles, coalesce(string_agg(CAST(am.pidx AS VARCHAR), ',' ORDER BY am.pidx), '') AS particles FROM j LEFT JOIN am ON am.event_id = j.event_id AND am.jet_id = j.jet_id GROUP BY ALL",
        "track_link_range": f"WITH {P} SELECT event_id, pidx, CAST(CASE WHEN charge <> 0 THEN 1 ELSE 0 END AS BIGINT) AS n_links, CASE WHEN charge <> 0 AND 4*pidx < 4*count(*) OVER (PARTITION BY event_id) - 4 THEN CAST(4*pidx AS BIGINT) END AS state FROM p",
        "constituent_gather": f"""WITH {P}, {J}, {ASSIGN} SELECT j.event_id, j.jet_id, coalesce(string_agg(CAST(p.pdg AS VARCHAR), ',' ORDER BY p.pidx), '') AS pdgs, {rnd('coalesce(sum(p.pt), 0.0)', 'sum_pt')}
 FROM j LEFT JOIN am ON am.event_id = j.event_id AND am.jet_id = j.jet_id LEFT JOIN p ON p.event_id = am.event_id AND p.pidx = am.pidx GROUP BY j.event_id, j.jet_id""",
        "lifetime_3d": f"{LIFE} SELECT event_id, pidx, {or_sentinel(['dxy', 'dz', 'd3', 'pca_x', 'pca_y', 'pca_z'])} FROM l",
        "lifetime_2d": f"{LIFE2} SELECT event_id, pidx, {or_sentinel([x + '_2d' for x in ('dxy', 'dz', 'd3', 'pca_x', 'pca_y', 'pca_z')])} FROM l_2d",
        "lifetime_errors": f"WITH {P}, {V}, {life(False)}, {life(True)} SELECT l.event_id, l.pidx, {or_sentinel([v + '_error' + s for s in ('', '_2d') for v in ('dxy', 'dz', 'd3', 'pca_x', 'pca_y', 'pca_z')]).replace('WHEN trk', 'WHEN l.trk')} FROM l JOIN l_2d USING (event_id, pidx)",
        "signed_impact": f"""{LIFE}, s AS (SELECT event_id, sum(px) jx, sum(py) jy, sum(pz) jz FROM p GROUP BY event_id),
 q AS (SELECT l.*, jx, jy, jz, sqrt(pow(pca_x - vx, 2) + pow(pca_y - vy, 2) + pow(pca_z - vz, 2)) AS far FROM l JOIN s USING (event_id)),
 q1 AS (SELECT *, CASE WHEN CASE WHEN far <= 1e-10 THEN jx*jx + jy*jy + jz*jz ELSE (pca_x - vx)*jx + (pca_y - vy)*jy + (pca_z - vz)*jz END >= 0 THEN 1 ELSE -1 END AS sg FROM q)
 SELECT event_id, pidx, {or_sentinel(['sg*abs(dxy)']).replace('AS sg*abs(dxy)', 'AS signed_dxy')}, {or_sentinel(['sg*abs(dz)']).replace('AS sg*abs(dz)', 'AS signed_dz')}, {or_sentinel(['sg*abs(d3)']).replace('AS sg*abs(d3)', 'AS signed_d3')} FROM q1""",
        "aleph_impact": f"""WITH {P}, {V}, a AS (SELECT *, cos(phi0) AS ux, sin(phi0) AS uy, xr + sin(phi0)*d0 AS x0, yr - cos(phi0)*d0 AS y0, z0 + zr AS zz FROM p JOIN v USING (event_id) WHERE trk),
 b AS (SELECT *, -((x0 - vx)*ux + (y0 - vy)*uy + (zz - vz)*tanl)/(ux*ux + uy*uy + tanl*tanl) AS s, c0*c0 + c2*c2 AS se2 FROM a),
 c AS (SELECT *, x0 + s*ux - vx AS dx, y0 + s*uy - vy AS dy, zz + s*tanl - vz AS dz0, pow(ux, 2)*se2 + pow(uy*c0, 2) + pow(ux*d0*c2, 2) + pow(s*uy*c2, 2) AS ex2, pow(uy, 2)*se2 + pow(ux*c0, 2) + pow(uy*d0*c2, 2) + pow(s*ux*c2, 2) AS ey2 FROM b)
 SELECT event_id, pidx, {rnd('abs(dz0)', 'dzval')}, {rnd('sqrt(tanl*tanl*se2 + pow(s*c14, 2) + c9*c9)', 'dzerr')}, {rnd('d0', 'd0val')}, {rnd('c0', 'd0err')}, {rnd('sqrt(dx*dx + dy*dy)', 'dxy')}, {rnd('sqrt(dx*dx*ex2 + dy*dy*ey2)/sqrt(dx*dx + dy*dy)', 'dxyerr')} FROM c""",
        "event_replicate": f"WITH {P}, {J}, s AS (SELECT event_id, count(*) AS n, sum(pt) AS t FROM p GROUP BY event_id) SELECT event_id, jet_id, n AS n_event_particles, {rnd('t', 'event_pt')} FROM j JOIN s USING (event_id)",
        "event_counts": f"WITH {P} SELECT event_id, {n_of(211, 321)} AS n_charged_hadrons, {n_of(11)} AS n_electrons, {n_of(13)} AS n_muons, {n_of(22)} AS n_photons, {n_of(130, 111)} AS n_neutral_hadrons, count(*) FILTER (pidx < 2) AS n_jets FROM p GROUP BY event_id",
        "met_ht": f"WITH {P} SELECT event_id, {rnd('sqrt(pow(sum(px), 2) + pow(sum(py), 2))', 'met')}, {rnd('sum(pt) FILTER (pidx < 2)', 'ht')} FROM p GROUP BY event_id",
        "sphericity_aplanarity": f"WITH {P}, {EIG} SELECT event_id, {rnd('l1', 'lambda1', 4)}, {rnd('tr - l1 - l3', 'lambda2', 4)}, {rnd('l3', 'lambda3', 4)}, {rnd('1.5*(tr - l3)', 'sphericity', 4)}, {rnd('1.5*l1', 'aplanarity', 4)} FROM m5",
        "constituent_sum_p4": f"WITH {P} SELECT event_id, count(*) AS n, {rnd('sqrt(pow(sum(px), 2) + pow(sum(py), 2))', 'pt')}, {rnd('sum(energy)', 'energy')}, {rnd('sum(pz)', 'pz')}, {rnd('sqrt(greatest(pow(sum(energy), 2) - pow(sum(px), 2) - pow(sum(py), 2) - pow(sum(pz), 2), 0))', 'mass', 3)} FROM p GROUP BY event_id",
        "relative_features": f"WITH {P}, {S} SELECT event_id, pidx, {rnd('pt/jpt', 'ptrel', 5)}, {rnd('energy/je', 'erel', 5)}, {rnd('eta - jeta', 'etarel', 5)}, {rnd(dr('eta', 'phi', 'jeta', 'jphi'), 'deltaR', 5)}, {rnd('abs(eta - jeta)', 'deta', 5)}, {rnd('abs(' + dphi('phi', 'jphi') + ')', 'dphi', 5)} FROM e",
        "species_flags": f"WITH {P} SELECT event_id, pidx, CAST(abs(pdg) IN (211, 321) AS INTEGER) AS isChargedHadron, CAST(abs(pdg) = 11 AS INTEGER) AS isElectron, CAST(abs(pdg) = 13 AS INTEGER) AS isMuon, CAST(pdg = 22 AS INTEGER) AS isPhoton, CAST(pdg IN (130, 111) AS INTEGER) AS isNeutralHadron FROM p",
        "decaymode_reduced": f"""WITH {P}, {TAUS}, r AS (SELECT event_id, tau_id, decaymode AS m, CASE WHEN decaymode = -1 THEN 15 WHEN decaymode IN (2, 3, 4) THEN 2 WHEN decaymode IN (5, 10) THEN 10 WHEN decaymode IN (6, 7, 8, 9, 11, 12, 13, 14) THEN 11 ELSE decaymode END AS reduced FROM tm)
 SELECT event_id, tau_id, reduced, CAST(CASE reduced WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 10 THEN 3 WHEN 11 THEN 4 WHEN 15 THEN 5 WHEN 16 THEN 5 END AS INTEGER) AS class_index,
 CAST(CASE WHEN m IN (0, 1) THEN m WHEN m IN (2, 3, 4) THEN 2 WHEN m = 10 THEN 3 WHEN m IN (11, 12, 13, 14) THEN 4 WHEN m IN (5, 6, 7, 8, 9, 15) THEN 5 ELSE -1 END AS INTEGER) AS plot_mode,
 CASE m WHEN 15 THEN 'RareDecayMode' WHEN 16 THEN 'LeptonicDecay' ELSE ['One', 'Two', 'Three'][CAST(m // 5 AS INTEGER) + 1] || 'Prong' || CASE WHEN m % 5 = 4 THEN 'N' ELSE CAST(m % 5 AS VARCHAR) END || 'PiZero' END AS name, m = 16 AS leptonic FROM r""",
        "dm_percentages": f"WITH {P}, {TAUS} SELECT decaymode, count(*) AS n, round(100.0*count(*)/sum(count(*)) OVER (), 2) AS percent FROM tm GROUP BY decaymode",
        "candidate_ids": f"WITH {P} SELECT event_id, pidx, CAST({CAND.replace('d.', '')} AS INTEGER) AS from_table, CAST({CAND.replace('d.', '')} AS INTEGER) AS from_track, charge AS q FROM p",
        "signature_confusion": f"WITH {P}, {SIG} SELECT gen_sig, reco_sig, count(*) AS n, {rnd('sum(CASE WHEN gen_sig = reco_sig THEN count(*) ELSE 0 END) OVER () / sum(count(*)) OVER ()', 'trace_fraction')} FROM sg GROUP BY gen_sig, reco_sig",
        "signature_topk": f"WITH {P}, {SIG} SELECT reco_sig, count(*) AS n FROM sg GROUP BY reco_sig ORDER BY n DESC, len({codes('reco_sig')}), {codes('reco_sig')} LIMIT 10",
        "signature_matrix": f"""WITH {P}, {SIG}, c AS (SELECT gen_sig, reco_sig, count(*) AS n FROM sg GROUP BY ALL),
 g AS (SELECT gen_sig, CAST(row_number() OVER (ORDER BY len({codes('gen_sig')}), {codes('gen_sig')}) - 1 AS INTEGER) AS gi FROM (SELECT DISTINCT gen_sig FROM c)),
 r AS (SELECT reco_sig, CAST(row_number() OVER (ORDER BY len({codes('reco_sig')}), {codes('reco_sig')}) - 1 AS INTEGER) AS ri FROM (SELECT DISTINCT reco_sig FROM c))
 SELECT gi AS gen_codes_index, ri AS reco_codes_index, {labels('gen_sig')} AS gen_codes_label, {labels('reco_sig')} AS reco_codes_label, n, {rnd('sum(CASE WHEN gi = ri THEN n ELSE 0 END) OVER () / sum(n) OVER ()', 'diagonal')} FROM c JOIN g USING (gen_sig) JOIN r USING (reco_sig)""",
        "seeded_split": f"WITH {P}, k AS (SELECT event_id, pidx, is_signal, {seed} AS key FROM p) SELECT event_id, pidx, CASE WHEN row_number() OVER (PARTITION BY is_signal ORDER BY key, event_id, pidx) <= floor(count(*) OVER (PARTITION BY is_signal)*0.9) THEN 'train' ELSE 'test' END AS split FROM k",
        "validation_one_scan": _one_scan(),
        "permuted_rows": _permuted(P, seed.replace("42*31", "0*31")),
        "chunk_ntile": "SELECT chunk, count(*) AS n, min(s_suppkey) AS first_key FROM (SELECT s_suppkey, CAST(ntile(20) OVER (ORDER BY s_suppkey) AS INTEGER) AS chunk FROM supplier) GROUP BY chunk",
        "union_schema_normalise": f"WITH {P} SELECT CASE WHEN is_signal THEN 'signal' ELSE 'background' END AS sample, event_id, pidx, {rnd('pt', 'rho')}, {rnd('energy', 't')} FROM p",
        "weight_matrix": f"WITH {P}, {wmat()} SELECT CAST(tb AS INTEGER) AS theta_bin, CAST(pb AS INTEGER) AS p_bin, {rnd('weight')} FROM wm",
        "weight_apply": f"WITH {P}, {wmat()}, {WAPPLY} SELECT event_id, pidx, theta_bin, p_bin, {rnd('cls_weight')} FROM wy WHERE is_signal",
        "hist_1d_np": hist("events", "value", 0.0, 100.0, 50),
        "hist_1d_flow": f"""WITH b AS (SELECT CASE WHEN value < 10 THEN -1 WHEN value >= 50 THEN 8 ELSE CAST(floor((value - 10)/5) AS INTEGER) END AS bin, CASE WHEN value = 50 THEN 7 ELSE greatest(0, least(7, CAST(floor((value - 10)/5) AS INTEGER))) END AS edge FROM events)
 SELECT CAST(i AS INTEGER) AS bin, CAST((SELECT count(*) FROM b WHERE b.bin = i) AS DOUBLE) AS value, 'bins' AS mode FROM range(-1, 9) r(i) UNION ALL SELECT CAST(i AS INTEGER), CAST((SELECT count(*) FROM b WHERE b.edge = i) AS DOUBLE), 'sum' FROM range(0, 8) r(i)""",
        "hist_reverse_cumulative": f"WITH h AS ({hist('events', 'value', 0.0, 100.0, 20)}) SELECT bin, (SELECT sum(value) FROM h) - sum(value) OVER (ORDER BY bin) AS value FROM h",
        "hist_density": f"{LIFE}, d AS (SELECT log10(dxy_error) AS x FROM l WHERE trk AND dxy_error > 0), h AS ({hist('d', 'x', -4.0, 0.0, 80)}) SELECT bin, {rnd('value / (sum(value) OVER () * 0.05)', 'value')} FROM h",
        "hist_2d_shape": f"""WITH {P}, {S}, q AS (SELECT is_signal, jeta - eta AS de, {dphi('jphi', 'phi')} AS dp, pt FROM e), b AS (SELECT is_signal, CAST({ubin('de', -1.95, 2.05, 20)} AS INTEGER) AS x_bin, CAST({ubin('dp', -1.95, 2.05, 20)} AS INTEGER) AS y_bin, pt FROM q)
 SELECT is_signal, x_bin, y_bin, {rnd('sum(pt)', 'value')} FROM b WHERE x_bin BETWEEN 0 AND 19 AND y_bin BETWEEN 0 AND 19 GROUP BY is_signal, x_bin, y_bin""",
        "hist_energy_2d": f"""WITH {P}, {G}, {MATCH}, q AS (SELECT a.pt AS l, b.pt AS g FROM m JOIN p a ON a.event_id = m.event_id AND a.pidx = left_id JOIN p b ON b.event_id = m.event_id AND b.pidx = right_id)
 SELECT CAST({ubin('l', 0.0, 11.0, 22)} AS INTEGER) AS x_bin, CAST({ubin('g', 0.0, 11.0, 22)} AS INTEGER) AS y_bin, CAST(count(*) AS DOUBLE) AS value FROM q GROUP BY ALL""",
        "hist_weighted_pair": f"""WITH {P}, {wmat()}, {WAPPLY}, r AS (SELECT min(pt) AS lo, max(pt) AS hi FROM p WHERE NOT is_signal)
 SELECT is_signal, CAST(least(49, floor((pt - lo)/(hi - lo)*50)) AS INTEGER) AS bin, count(*) AS n, {rnd('sum(cls_weight)', 'sum_w')} FROM wy, r WHERE pt BETWEEN lo AND hi GROUP BY ALL""",
        "hist_ratio": f"""WITH h AS ({hist('events', 'value', 0.0, 100.0, 10, 'event_type')}), d AS (SELECT *, value / sum(value) OVER (PARTITION BY event_type) AS den FROM h)
 SELECT a.event_type, a.bin, {rnd('CASE WHEN b.den > 0 THEN a.den / b.den END', 'ratio')} FROM d a JOIN d b ON a.bin = b.bin AND b.event_type = 'click' WHERE a.event_type <> 'click'""",
        "hist_per_jet": f"WITH {P}, s AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM p GROUP BY event_id) {hist('s', 'n', 0.0, 50.0, 50)}",
        "species_hist": f"WITH {P}, q AS (SELECT abs(pdg) AS species, pt FROM p) {hist('q', 'pt', 0.0, 11.0, 22, 'species')}",
        "composition_fractions": f"WITH {P} SELECT event_id, {rnd(n_of(211, 321) + ' / count(*)', 'charged')}, {rnd(n_of(130, 111) + ' / count(*)', 'neutral')}, {rnd(n_of(22) + ' / count(*)', 'photon')}, {rnd(n_of(11, 13) + ' / count(*)', 'lepton')} FROM p GROUP BY event_id",
        "near_fraction": f"WITH {P}, {S} SELECT is_signal, {rnd('avg(CASE WHEN abs(eta - jeta) < 0.8 THEN 1.0 ELSE 0.0 END)', 'near_eta', 5)}, {rnd('max(' + dr('eta', 'phi', 'jeta', 'jphi') + ')', 'max_dr', 5)} FROM e GROUP BY is_signal",
        "branching_ratios": f"WITH {P}, {TAUS}, c AS (SELECT decaymode, count(*) AS n FROM tm GROUP BY decaymode), z AS (SELECT n AS n0 FROM c WHERE decaymode = 0) SELECT decaymode, {rnd('n/n0', 'ratio')}, {rnd('n/n0*sqrt(1/n + 1/n0)', 'error')} FROM c, z",
        "uncommon_particles": f"WITH {P} SELECT event_id, count(DISTINCT abs(pdg)) FILTER (abs(pdg) NOT IN (11, 12, 13, 14, 16, 130, 211)) AS n_uncommon FROM p GROUP BY event_id",
        "pad_clip_tensor": """WITH s AS (SELECT vec_id, embedding AS v FROM embeddings)
 SELECT vec_id, CAST(w AS INTEGER) AS width, greatest(1, len(list_filter(v, lambda x: x > 2.5))) AS n_big, CAST(i AS INTEGER) AS i, round(CASE WHEN i < len(v) THEN CAST(v[i + 1] AS DOUBLE) ELSE 0.0 END, 6) + 0.0 AS value, i < len(v) AS valid FROM s, (VALUES (20), (80)) q(w), range(0, 80) r(i) WHERE i < w""",
        "feature_matrix": f"""{LIFE}, f AS (SELECT p.event_id, p.pidx, ln(greatest(p.pt, 1e-6)) AS logpt, ln(greatest(p.energy, 1e-6)) AS loge, CAST(p.pdg = 22 AS INTEGER) AS isphoton, p.charge, CASE WHEN l.trk THEN l.dz / l.dz_error ELSE 1.0 END AS dz_sig FROM p JOIN l USING (event_id, pidx)),
 ev AS (SELECT DISTINCT event_id FROM p)
 SELECT ev.event_id, CAST(i AS INTEGER) AS i, f.pidx IS NOT NULL AS valid, round(CAST(CAST(coalesce(logpt, 0) AS FLOAT) AS DOUBLE), 3) AS logpt, round(CAST(CAST(coalesce(loge, 0) AS FLOAT) AS DOUBLE), 3) AS loge, CAST(coalesce(isphoton, 0) AS DOUBLE) AS "isPhoton", CAST(coalesce(charge, 0) AS DOUBLE) AS charge, round(CAST(CAST(coalesce(dz_sig, 0) AS FLOAT) AS DOUBLE), 3) AS dz_sig
 FROM ev CROSS JOIN range(0, 8) r(i) LEFT JOIN f ON f.event_id = ev.event_id AND f.pidx = i""",
        "tensor_targets": f"WITH {P}, {S} SELECT event_id, pidx, {rnd('ln(greatest(pt / greatest(jpt, 1e-6), 1e-6))', 'log_pt_ratio', 4)}, {rnd('eta - jeta', 'deta_target', 4)}, {rnd('sin(phi - jphi)', 'sin_dphi', 4)}, {rnd('cos(phi - jphi)', 'cos_dphi', 4)} FROM e",
        "tensor_labels": f"""WITH {P}, {TAUS}, c AS (SELECT event_id, tau_id, decaymode, CAST(CASE WHEN decaymode IN (0, 1) THEN decaymode WHEN decaymode IN (2, 3, 4) THEN 2 WHEN decaymode IN (5, 10) THEN 3 WHEN decaymode IN (15, 16) THEN 5 ELSE 4 END AS INTEGER) AS decay_class FROM tm)
 SELECT event_id, tau_id, decay_class, CAST(decaymode <> -1 AS INTEGER) AS is_tau, repeat('0', decay_class) || '1' || repeat('0', 5 - decay_class) AS one_hot FROM c""",
        "hist_pt_ratio": f"""WITH {P}, {G}, {MATCH}, q AS (SELECT a.pt / g.pt AS x FROM m JOIN p a ON a.event_id = m.event_id AND a.pidx = left_id JOIN g ON g.event_id = m.event_id AND g.pidx = right_id),
 h AS ({hist('q', 'x', 0.75, 1.25, 100)}) SELECT bin, {rnd('value / (SELECT count(*) FROM q)', 'value')} FROM h""",
        "hist_log_ratio": f"""WITH e AS (SELECT event_type, log10(value) AS x FROM events WHERE value > 0), r AS (SELECT min(x) AS lo, max(x) AS hi FROM e),
 b AS (SELECT event_type, CAST(least(11, floor((x - lo)/(hi - lo)*12)) AS INTEGER) AS bin, count(*) AS n FROM e, r GROUP BY ALL), s AS (SELECT *, n / sum(n) OVER (PARTITION BY event_type) AS f FROM b)
 SELECT a.event_type, a.bin, {rnd('a.f / c.f', 'ratio')} FROM s a LEFT JOIN s c ON c.bin = a.bin AND c.event_type = 'click' WHERE a.event_type <> 'click'""",
        "hist_decay_modes": f"WITH {P}, {TAUS}, h AS (SELECT CAST(i AS INTEGER) AS bin, CAST((SELECT count(*) FROM tm WHERE least(decaymode, 15) = i) AS DOUBLE) AS value FROM range(0, 16) r(i)) SELECT bin, value, round(100.0*value/sum(value) OVER (), 2) AS percent FROM h",
        "hist_shape_by_mode": f"""WITH {P}, {S}, {TAUS}, f AS (SELECT event_id, min(decaymode) AS m FROM tm GROUP BY event_id),
 q AS (SELECT CASE WHEN m IN (0, 1) THEN m WHEN m IN (2, 3, 4) THEN 2 WHEN m = 10 THEN 3 WHEN m BETWEEN 11 AND 14 THEN 4 ELSE 9 END AS mode, event_id, jeta - eta AS de, {dphi('jphi', 'phi')} AS dp, pt FROM e JOIN f USING (event_id)),
 n AS (SELECT mode, count(DISTINCT event_id) AS n FROM q GROUP BY mode), b AS (SELECT mode, CAST({ubin('de', -1.95, 2.05, 20)} AS INTEGER) AS x_bin, CAST({ubin('dp', -1.95, 2.05, 20)} AS INTEGER) AS y_bin, pt FROM q WHERE mode <= 4)
 SELECT CAST(mode AS INTEGER) AS mode, x_bin, y_bin, {rnd('sum(pt) / any_value(n.n)', 'value')} FROM b JOIN n USING (mode) WHERE x_bin BETWEEN 0 AND 19 AND y_bin BETWEEN 0 AND 19 GROUP BY mode, x_bin, y_bin""",
        "hist_jet_pt": f"""WITH {P}, q AS (SELECT is_signal, least(sqrt(pow(sum(px), 2) + pow(sum(py), 2)), 219.0) AS x FROM p GROUP BY event_id, is_signal), h AS ({hist('q', 'x', 0.0, 220.0, 50, 'is_signal')})
 SELECT is_signal, bin, {rnd('value / (sum(value) OVER (PARTITION BY is_signal) * 4.4)', 'value')} FROM h""",
        "hist_weights": f"""WITH {P}, {wmat()}, {WAPPLY}, q AS (SELECT is_signal, round(cls_weight, 6) + 0.0 AS x FROM wy), h AS ({hist('q', 'x', 0.0, 1.0, 50, 'is_signal')})
 SELECT is_signal, bin, {rnd('value / sum(value) OVER (PARTITION BY is_signal)', 'value')} FROM h""",
        "track_impact_map": f"""{LIFE}, b AS (SELECT CAST({ubin('dz', 0.0, 0.2, 20)} AS INTEGER) AS x_bin, CAST({ubin('dxy', 0.0, 0.2, 20)} AS INTEGER) AS y_bin FROM l WHERE trk)
 SELECT x_bin, y_bin, CAST(count(*) AS DOUBLE) AS value FROM b WHERE x_bin BETWEEN 0 AND 19 AND y_bin BETWEEN 0 AND 19 GROUP BY ALL""",
        "native_tracks": f"""WITH {P} SELECT event_id, pidx, pdg, CAST(charge AS DOUBLE) AS charge, {', '.join(f"CASE WHEN trk THEN CAST(CAST({x} AS FLOAT) AS DOUBLE) END AS {n}" for n, x in dict(d0='d0', z0='z0', phi0='phi0', tanl='tanl', omega='omega', c_d0='c0', c_tan='c14').items())},
 {', '.join(f"CASE WHEN trk THEN CAST({c}r AS DOUBLE) END AS {c}r" for c in 'xyz')} FROM p""",
        "native_tau_truth": f"""WITH {P}, {TAUS} SELECT event_id, tau_id, charge, decaymode, {rnd('se', 'vis_energy')}, {rnd('full_pt')}, CAST(tau_id/100.0 AS DOUBLE) AS "DV_x", CAST(tau_id % 3/50.0 AS DOUBLE) AS "DV_y", CAST(-tau_id/200.0 AS DOUBLE) AS "DV_z", coalesce(seen_pdgs, '') AS daughter_pdgs FROM tm""",
        "lifetime_native": f"""WITH {P}, {V}, f AS (SELECT * REPLACE ({', '.join(f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}" for c in ('d0', 'z0', 'phi0', 'tanl', 'omega', 'c0', 'c2', 'c9', 'c14'))}) FROM p JOIN v USING (event_id)), {life(False, 'f')}, {life(True, 'f')},
 b AS (SELECT l.*, l_2d.dxy_2d, l_2d.dz_2d, l_2d.d3_2d, l_2d.dxy_error_2d, l_2d.dz_error_2d, l_2d.d3_error_2d FROM l JOIN l_2d USING (event_id, pidx))
 SELECT event_id, pidx, {or_sentinel([*VARIABLES], VARIABLES, 4)} FROM b""",
        "lifetime_track": f"{LIFE} SELECT event_id, pidx, {or_sentinel(['d0', 'z0', 'd0_error', 'z0_error', 'phi0', 'tanl', 'omega', 'vx', 'vy', 'vz'], dict(vx='pvx', vy='pvy', vz='pvz'))} FROM l",
        "event_signed_impact": f"""{LIFE}, {life(True)}, j AS (SELECT event_id, pidx AS jet_id, px AS jx, py AS jy, pz AS jz FROM p WHERE pidx < 2),
 q AS (SELECT l.*, dxy_2d, jet_id, jx, jy, jz, sqrt(pow(l.pca_x - l.vx, 2) + pow(l.pca_y - l.vy, 2) + pow(l.pca_z - l.vz, 2)) AS far FROM l JOIN l_2d USING (event_id, pidx) JOIN j USING (event_id)),
 q1 AS (SELECT *, CASE WHEN CASE WHEN far <= 1e-10 THEN jx*jx + jy*jy + jz*jz ELSE (pca_x - vx)*jx + (pca_y - vy)*jy + (pca_z - vz)*jz END >= 0 THEN 1 ELSE -1 END AS sg FROM q)
 SELECT event_id, jet_id, pidx, {or_sentinel(['sg*abs(dxy)', 'sg*abs(z0)', 'sg*abs(dxy_2d)'], {'sg*abs(dxy)': 'signed_dxy', 'sg*abs(z0)': 'signed_z0', 'sg*abs(dxy_2d)': 'signed_dxy_2d'})} FROM q1""",
        "archival_candidates": f"""WITH {archival()}
 SELECT event_id, pidx, CAST(charge AS DOUBLE) AS charge, CAST(abs(pdg) IN (211, 321) AS INTEGER) AS "isChargedHadron", CAST(abs(pdg) = 11 AS INTEGER) AS "isElectron", CAST(abs(pdg) = 13 AS INTEGER) AS "isMuon", CAST(pdg = 22 AS INTEGER) AS "isPhoton", CAST(pdg IN (130, 111) AS INTEGER) AS "isNeutralHadron",
 {rnd('sqrt(greatest(energy*energy - pow(pt*cosh(eta), 2), 0))', 'mass', 3)}, {rnd('CASE WHEN trk THEN d0 ELSE -999.9 END', 'd0val', 3)}, {rnd('CASE WHEN trk THEN c0 ELSE -999.9 END', 'd0err', 3)}, {rnd('CASE WHEN trk THEN abs(zz + s*tanl - vz) ELSE -999.9 END', 'dzval', 3)}, {rnd('CASE WHEN trk THEN sqrt(tanl*tanl*se2 + pow(s*c14, 2) + c9*c9) ELSE -999.9 END', 'dzerr', 3)} FROM b""",
        "particle_labels": f"""WITH {P}, {S} SELECT event_id, pidx, CASE abs(pdg) WHEN 211 THEN 'charged hadron' WHEN 321 THEN 'charged kaon' WHEN 130 THEN 'neutral hadron' WHEN 111 THEN 'neutral pion' WHEN 22 THEN 'photon' WHEN 11 THEN 'electron' WHEN 13 THEN 'muon' WHEN 15 THEN 'tau' ELSE 'invisible' END AS name,
 {rnd(dphi('phi', 'jphi'), 'phirel', 5)}, CAST(charge = 1 AS INTEGER) AS charge_flag,
 {rnd('CASE WHEN mass > 0.01 AND sqrt(greatest(je*je - jx*jx - jy*jy - jz*jz, 0)) > 0.05 THEN ln(greatest(mass / sqrt(greatest(je*je - jx*jx - jy*jy - jz*jz, 0)), 1e-6)) END', 'log_mass_ratio', 4)} FROM e""",
        "hist_log_axis": hist_list("events", "value", [10.0 ** (-1 + i * 0.25) for i in range(17)], "event_type"),
        "hist_variable_edges": f"""WITH {P}, b AS (SELECT is_signal, CASE WHEN pt < 0.1 THEN 0 WHEN pt < 0.5 THEN 1 WHEN pt < 1 THEN 2 WHEN pt < 2.5 THEN 3 WHEN pt < 7.5 THEN 4 ELSE 5 END AS bin, eta FROM p)
 SELECT k.is_signal, CAST(i AS INTEGER) AS bin, round(coalesce(sum(eta), 0.0), 3) + 0.0 AS value FROM (SELECT DISTINCT is_signal FROM p) k CROSS JOIN range(0, 6) r(i) LEFT JOIN b ON b.is_signal = k.is_signal AND b.bin = i GROUP BY ALL""",
        "hist_lifetime": f"{LIFE}, q AS (SELECT is_signal, dz FROM l JOIN p USING (event_id, pidx) WHERE l.trk) {hist('q', 'dz', 0.0, 0.25, 40, 'is_signal')}",
        "hist_log_sigma": f"{LIFE}, d AS (SELECT log10(d3_error) AS x FROM l WHERE trk AND d3_error > 0), h AS ({hist('d', 'x', -4.0, 0.0, 79)}) SELECT bin, {rnd('value / (sum(value) OVER () * (4.0 / 79))', 'value')} FROM h",
        "hist_energy_map": f"""WITH {P}, {G}, {MATCH}, q0 AS (SELECT a.pt AS r, g.pt AS g FROM m JOIN p a ON a.event_id = m.event_id AND a.pidx = left_id JOIN g ON g.event_id = m.event_id AND g.pidx = right_id),
 q AS (SELECT r / t AS r, g / t AS g FROM q0, (SELECT greatest(max(r), max(g)) AS t FROM q0)) SELECT CAST({ubin('g', 0.0, 1.0, 25)} AS INTEGER) AS x_bin, CAST({ubin('r', 0.0, 1.0, 25)} AS INTEGER) AS y_bin, CAST(count(*) AS DOUBLE) AS value FROM q GROUP BY ALL""",
        "within_beam": f"WITH {P} SELECT event_id FROM p GROUP BY event_id HAVING sum(energy) <= 91.2 AND max(pt*9) <= 45.6",
        "published_ratios": f"""WITH {P}, {TAUS}, c AS (SELECT decaymode, count(*) AS n FROM tm GROUP BY decaymode), b(decaymode, f) AS (VALUES (0, 10.82), (1, 25.49), (2, 9.26), (10, 8.99), (11, 2.74), (16, 35.21)), z AS (SELECT n AS n0 FROM c WHERE decaymode = 0)
 SELECT CAST(c.decaymode AS INTEGER) AS decaymode, {rnd('n/n0', 'ratio')}, {rnd('n/n0*sqrt(1/n + 1/n0)', 'error')}, {rnd('CAST(f AS DOUBLE)/10.82', 'published')} FROM c JOIN b USING (decaymode), z""",
        "validation_tables": f"""WITH {P}, {TAUS}, f AS (SELECT event_id, min(decaymode) AS m FROM tm GROUP BY event_id),
 q AS (SELECT CASE WHEN is_signal THEN 'signal' ELSE 'background' END AS sample, sqrt(pow(sum(px), 2) + pow(sum(py), 2)) AS pt, sqrt(greatest(pow(sum(energy), 2) - pow(sum(px), 2) - pow(sum(py), 2) - pow(sum(pz), 2), 0)) AS mass, CAST(count(*) AS DOUBLE) AS n, CAST(coalesce(any_value(m), -1) AS DOUBLE) AS mode FROM p LEFT JOIN f USING (event_id) GROUP BY event_id, is_signal)
 {' UNION ALL '.join(f"SELECT sample, bin, value, '{name}' AS variable FROM ({hist('q', x, 0.0, top, bins, 'sample')})" for name, x, top, bins in (('jet_pt', 'pt', 220.0, 50), ('jet_mass', 'mass', 10.0, 50), ('n_cands', 'n', 50.0, 50), ('decaymode', 'mode', 16.0, 16)))}""",
        "weighted_samples": f"""WITH {P}, k AS (SELECT *, {seed} AS key FROM p), sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY is_signal ORDER BY key, event_id, pidx) <= floor(count(*) OVER (PARTITION BY is_signal)*0.9) THEN 'train' ELSE 'test' END AS split FROM k),
 {wmat().replace('FROM p)', 'FROM sp)').replace('is_signal FROM wa)', "is_signal FROM wa WHERE split = 'train')")}, wn AS (SELECT tb, pb, least(coalesce(wt.f, 0), wo.f) / wo.f AS weight FROM wo LEFT JOIN wt USING (tb, pb)),
 {WAPPLY.replace('FROM wa)', 'FROM wa)').split(', wy AS')[0]}, wy AS (SELECT wx.*, coalesce(CASE WHEN is_signal THEN wm.weight ELSE wn.weight END, 0.0) AS cls_weight FROM wx LEFT JOIN wm ON wm.tb = theta_bin AND wm.pb = p_bin LEFT JOIN wn ON wn.tb = theta_bin AND wn.pb = p_bin)
 SELECT is_signal, split, count(*) AS n, {rnd('sum(cls_weight)', 'sum_w', 4)} FROM wy GROUP BY is_signal, split""",
        "jets_ee_genkt": f"WITH RECURSIVE {P}, {jets(0.4)} SELECT event_id, jet_id, {rnd('px', n=8)}, {rnd('py', n=8)}, {rnd('pz', n=8)}, {rnd('energy', n=8)}, array_to_string(m, ',') AS constituents FROM jt",
        "thrust": f"WITH RECURSIVE {P}, {thrust()} SELECT event_id, {rnd('thrust', n=5)} FROM th",
        "archival_events": f"""WITH RECURSIVE {P}, {EIG}, {thrust()}, o AS (SELECT event_id, sqrt(pow(sum(px), 2) + pow(sum(py), 2)) AS met, sum(pt) FILTER (pidx < 2) AS ht, count(*) FILTER (pidx < 2) AS n_jets FROM p GROUP BY event_id
 HAVING NOT bool_or(pt <= 0 OR energy >= 45.6 OR pt = -999.9) AND NOT bool_or(pidx < 2 AND (pt < 0 OR energy > 91.2)))
 SELECT event_id, {rnd('met')}, {rnd('ht')}, n_jets, {rnd('1.5*(tr - l3)', 'sphericity', 4)}, {rnd('thrust', n=5)} FROM o JOIN m5 USING (event_id) JOIN th USING (event_id)""",
        "jet_ntuple": f"""WITH RECURSIVE {P}, {V}, {G}, {TAUS}, {life(False)}, {life(True)}, gp AS (SELECT event_id, pidx, pdg, pt*cos(phi) AS px, pt*sin(phi) AS py, pt*sinh(eta) AS pz, pt*cosh(eta) AS energy FROM g), {jets(0.4)}, {jets(0.4, 'gp', 'g')},
 rj AS (SELECT *, sqrt(px*px + py*py) AS pt, asinh(pz/sqrt(px*px + py*py)) AS eta, atan2(py, px) AS phi FROM jt),
 bad AS (SELECT DISTINCT c.event_id, c.jet_id FROM (SELECT event_id, jet_id, unnest(m) AS pidx FROM jtg) c JOIN gp USING (event_id, pidx) WHERE abs(pdg) IN (13, 15)),
 gj AS (SELECT *, sqrt(px*px + py*py) AS pt, asinh(pz/sqrt(px*px + py*py)) AS eta, atan2(py, px) AS phi FROM jtg ANTI JOIN bad USING (event_id, jet_id)),
 mt AS (SELECT * FROM (SELECT a.event_id, a.jet_id, b.jet_id AS gen_id, b.pt AS gen_pt, {dr('a.eta', 'a.phi', 'b.eta', 'b.phi')} AS dr, row_number() OVER (PARTITION BY a.event_id, a.jet_id ORDER BY {dr('a.eta', 'a.phi', 'b.eta', 'b.phi')}, b.jet_id) AS k FROM rj a JOIN gj b USING (event_id)) WHERE k = 1 AND dr < 0.4),
 vt AS (SELECT *, asinh(sz/sqrt(sx*sx + sy*sy)) AS teta, atan2(sy, sx) AS tphi FROM tm WHERE se <> 0),
 tj AS (SELECT * FROM (SELECT vt.event_id, vt.tau_id, vt.decaymode, vt.se, b.jet_id AS gen_id, {dr('teta', 'tphi', 'b.eta', 'b.phi')} AS dr, row_number() OVER (PARTITION BY vt.event_id, vt.tau_id ORDER BY {dr('teta', 'tphi', 'b.eta', 'b.phi')}, b.jet_id) AS k FROM vt JOIN gj b USING (event_id)) WHERE k = 1 AND dr < 0.4),
 tl AS (SELECT event_id, gen_id, arg_max(decaymode, tau_id) AS mode, arg_max(se, tau_id) AS se FROM tj GROUP BY ALL),
 cs AS (SELECT r.event_id, r.jet_id, r.px AS jx, r.py AS jy, r.pz AS jz, unnest(m) AS pidx FROM rj r),
 ce AS (SELECT cs.event_id, cs.jet_id, p.pdg, l.trk, CASE WHEN sqrt(pow(pca_x - l.vx, 2) + pow(pca_y - l.vy, 2) + pow(pca_z - l.vz, 2)) <= 1e-10 OR (pca_x - l.vx)*jx + (pca_y - l.vy)*jy + (pca_z - l.vz)*jz >= 0 THEN 1 ELSE -1 END AS sg, l.dxy, l_2d.dxy_error_2d
  FROM cs JOIN p USING (event_id, pidx) JOIN l USING (event_id, pidx) JOIN l_2d USING (event_id, pidx)),
 ca AS (SELECT event_id, jet_id, count(*) AS n, sum(CASE WHEN trk THEN sg*dxy ELSE -1000 END) AS s1, sum(CASE WHEN trk THEN dxy_error_2d ELSE -1000 END) AS s2, bool_or(abs(pdg) IN (11, 13)) AS lepton FROM ce GROUP BY ALL)
 SELECT mt.event_id, mt.jet_id, {rnd('rj.pt', 'pt')}, {rnd('mt.gen_pt', 'gen_pt')}, mode AS gen_jet_tau_decaymode, {rnd('tl.se', 'vis_energy')}, CAST(n AS INTEGER) AS n_cands, {rnd('s1', 'sum_signed_dxy', 4)}, {rnd('s2', 'sum_error', 4)}
 FROM mt JOIN rj USING (event_id, jet_id) JOIN ca USING (event_id, jet_id) JOIN tl ON tl.event_id = mt.event_id AND tl.gen_id = mt.gen_id WHERE NOT lepton AND mode <> 16""",
        "native_ntuple": f"""WITH RECURSIVE {P}, gp AS (SELECT event_id, pidx, pdg, px, py, pz, energy FROM p WHERE status = 1 AND abs(pdg) NOT IN (12, 14, 16)), {jets(0.4)}, {jets(0.4, 'gp', 'g')},
 rj AS (SELECT *, asinh(pz/sqrt(px*px + py*py)) AS eta, atan2(py, px) AS phi FROM jt),
 bad AS (SELECT DISTINCT c.event_id, c.jet_id FROM (SELECT event_id, jet_id, unnest(m) AS pidx FROM jtg) c JOIN gp USING (event_id, pidx) WHERE abs(pdg) IN (13, 15)),
 gj AS (SELECT *, asinh(pz/sqrt(px*px + py*py)) AS eta, atan2(py, px) AS phi FROM jtg ANTI JOIN bad USING (event_id, jet_id)),
 mt AS (SELECT a.event_id, a.jet_id FROM rj a JOIN gj b USING (event_id) GROUP BY ALL HAVING min({dr('a.eta', 'a.phi', 'b.eta', 'b.phi')}) < 0.4),
 ca AS (SELECT c.event_id, c.jet_id, count(*) AS n, any_value(np) AS np, bool_or(abs(pdg) IN (11, 13)) AS lepton FROM (SELECT event_id, jet_id, unnest(m) AS pidx FROM rj) c JOIN p USING (event_id, pidx) GROUP BY ALL)
 SELECT mt.event_id, mt.jet_id, {rnd('energy', n=4)}, -1 AS gen_jet_tau_decaymode, CAST(n AS INTEGER) AS n_cands, np AS n_event, CAST(0 AS INTEGER) AS n_daughters FROM mt JOIN rj USING (event_id, jet_id) JOIN ca USING (event_id, jet_id) WHERE NOT lepton""",
        "archival_jets": f"""WITH RECURSIVE {archival()}, pp AS (SELECT *, sqrt(px*px + py*py) AS ppt, asinh(pz/sqrt(px*px + py*py)) AS peta, atan2(py, px) AS pphi FROM b), {jets(0.8)},
 rj AS (SELECT event_id, jet_id, energy AS je, m, sqrt(px*px + py*py) AS jpt, asinh(pz/sqrt(px*px + py*py)) AS jeta, atan2(py, px) AS jphi FROM jt),
 c AS (SELECT event_id, jet_id, je, jpt, jeta, jphi, unnest(m) AS pidx FROM rj)
 SELECT event_id, jet_id, count(*) AS jet_nparticles, {rnd('any_value(jpt)', 'jet_pt', 8)}, {rnd('sqrt(greatest(pow(sum(energy), 2) - pow(sum(px), 2) - pow(sum(py), 2) - pow(sum(pz), 2), 0))', 'mass_from_p4s', 3)}, CAST(count(*) AS INTEGER) AS n_parts,
 {rnd('max(CASE WHEN trk THEN abs(zz + s*tanl - vz) ELSE -999.9 END)', 'top_dz', 3)}, {rnd('sum(ppt/jpt)', 'sum_ptrel', 5)}, {rnd('max(' + dr('peta', 'pphi', 'jeta', 'jphi') + ')', 'max_dr', 5)}, max(CASE WHEN pdg = 22 THEN 1.0::DOUBLE ELSE 0 END) AS photon FROM c JOIN pp USING (event_id, pidx) GROUP BY event_id, jet_id HAVING any_value(jpt) > 0 AND any_value(je) <= 91.2 AND NOT bool_or(ppt <= 0 OR energy >= 45.6)""",
        "stored_archival_jets": f"""WITH {archival()}, pp AS (SELECT *, sqrt(px*px + py*py) AS ppt, asinh(pz/sqrt(px*px + py*py)) AS peta, atan2(py, px) AS pphi FROM b),
 sj AS (SELECT event_id, CAST(pidx // 5 AS INTEGER) AS jet_id, 1.03*ppt AS jpt, asinh(0.97*pz/(1.03*ppt)) AS jeta, pphi AS jphi FROM pp WHERE pidx % 5 = 0),
 n AS (SELECT * FROM (SELECT pp.*, jet_id, jpt, jeta, jphi, {dr('peta', 'pphi', 'jeta', 'jphi')} AS near, row_number() OVER (PARTITION BY event_id, pidx ORDER BY {dr('peta', 'pphi', 'jeta', 'jphi')}, jet_id) AS k FROM pp JOIN sj USING (event_id)) WHERE k = 1 AND near <= 0.8)
 SELECT event_id, jet_id, count(*) AS jet_nparticles, {rnd('any_value(jpt)', 'jet_pt', 8)}, {rnd('sqrt(greatest(pow(sum(energy), 2) - pow(sum(px), 2) - pow(sum(py), 2) - pow(sum(pz), 2), 0))', 'mass_from_p4s', 3)}, CAST(count(*) AS INTEGER) AS n_parts,
 {rnd('max(CASE WHEN trk THEN abs(zz + s*tanl - vz) ELSE -999.9 END)', 'top_dz', 3)}, {rnd('sum(ppt/jpt)', 'sum_ptrel', 5)}, {rnd('max(' + dr('peta', 'pphi', 'jeta', 'jphi') + ')', 'max_dr', 5)}, max(CASE WHEN pdg = 22 THEN 1.0::DOUBLE ELSE 0 END) AS photon FROM n GROUP BY event_id, jet_id HAVING any_value(jpt) > 0 AND NOT bool_or(ppt <= 0)""",
    }
    return found | {"jets_by_sql": found["jets_ee_genkt"], "thrust_by_sql": found["thrust"]}
