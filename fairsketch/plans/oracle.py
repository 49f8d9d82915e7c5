"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark plans: nearest centres by cross join + ``row_number``,
minimum distances by ``least``, within-group scatter by two passes, the balance search as a
recursive CTE, sketches by joining items with a ``VALUES`` table of hash parameters.  Doubles
are rounded to ``DIGITS`` places (``+ 0.0`` turns a rounded ``-0.0`` into ``0.0``), integers
are ``BIGINT``.
"""

from __future__ import annotations

from ..functions.hashing import HashFamily, SketchSpec
from ..operators import seeding
from ..sources.tables import BATCH_SIZE
from . import params as P


def dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def rnd(expr: str) -> str:
    return f"(round({expr}, {P.DIGITS}) + 0.0)"


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


# ---------------------------------------------------------------- point views

PTS3 = (f"pts AS (SELECT row_number() OVER () AS pid, l_quantity / {dbl(50)} AS x0, "
        f"l_discount * {dbl(10)} AS x1, l_tax * {dbl(10)} AS x2, "
        f"CASE WHEN l_linestatus = 'O' THEN 'A' ELSE 'B' END AS grp FROM lineitem)")

EMB_COLS = ", ".join(f"CAST(embedding[{j + 1}] AS DOUBLE) AS x{j}" for j in range(64))
EMB = (f"pts AS (SELECT vec_id AS pid, label, {EMB_COLS}, "
       f"CASE WHEN label % 2 = 0 THEN 'A' ELSE 'B' END AS grp FROM embeddings)")
EMB_CENTERS = ("cen AS (SELECT label AS cid, "
               + ", ".join(f"avg(x{j}) AS c{j}" for j in range(64)) + " FROM pts GROUP BY label)")


def centers_values(cs, name: str = "cen") -> str:
    d = len(cs[0])
    rows = ", ".join("(" + ", ".join([str(i)] + [dbl(v) for v in c]) + ")" for i, c in enumerate(cs))
    cols = ", ".join(["cid"] + [f"c{j}" for j in range(d)])
    return f"{name} AS (SELECT * FROM (VALUES {rows}) AS v({cols}))"


CEN3 = centers_values(P.CENTERS_PTS3)


def _d2(d: int, p: str = "p", c: str = "c") -> str:
    return " + ".join(f"({p}.x{j} - {c}.c{j}) * ({p}.x{j} - {c}.c{j})" for j in range(d))


def assign_ctes(pts: str, cen: str, d: int, name: str) -> list[str]:
    """``name``: every point with its nearest centre ``cid`` (lowest id on ties) and ``d2``."""
    return [
        f"{name}_all AS (SELECT p.*, c.cid, {_d2(d)} AS d2 FROM {pts} p CROSS JOIN {cen} c)",
        f"{name} AS (SELECT * FROM {name}_all QUALIFY row_number() OVER (PARTITION BY pid ORDER BY d2, cid) = 1)",
    ]


def min_d2_expr(cs, p: str = "p") -> str:
    terms = []
    for c in cs:
        terms.append(" + ".join(f"({p}.x{j} - {dbl(v)}) * ({p}.x{j} - {dbl(v)})" for j, v in enumerate(c)))
    return f"least({', '.join(terms)})"


def _cols(prefix: str, d: int, alias: str = "") -> str:
    return ", ".join(f"{alias}{prefix}{j}" for j in range(d))


# ---------------------------------------------------------------- fair step / Lloyd step

def _x(g: str, s: str) -> str:
    return f"(((1.0 - {g}) * {s}.beta * {s}.ell) / ({g} * {s}.alpha + (1.0 - {g}) * {s}.beta))"


def fair_step_ctes(pts: str, cen: str, d: int, o: str) -> list[str]:
    """One fair Lloyd step.  Defines ``{o}_st`` (cluster statistics), ``{o}_f`` (fixed terms),
    ``{o}_g`` (balance search), ``{o}_new`` (moved centres + gamma) and ``{o}_all`` (all K centres,
    an empty cluster keeping its previous one)."""
    ctes = assign_ctes(pts, cen, d, f"{o}_a")
    means = ", ".join(f"avg(x{j}) FILTER (WHERE grp = 'A') AS ma{j}, avg(x{j}) FILTER (WHERE grp = 'B') AS mb{j}"
                      for j in range(d))
    ctes.append(f"{o}_m AS (SELECT cid, count(*) FILTER (WHERE grp = 'A') AS n_a, "
                f"count(*) FILTER (WHERE grp = 'B') AS n_b, {means} FROM {o}_a GROUP BY cid)")
    sa = " + ".join(f"(a.x{j} - m.ma{j}) * (a.x{j} - m.ma{j})" for j in range(d))
    sb = " + ".join(f"(a.x{j} - m.mb{j}) * (a.x{j} - m.mb{j})" for j in range(d))
    ctes.append(f"{o}_s AS (SELECT a.cid, sum(CASE WHEN a.grp = 'A' THEN {sa} END) AS sa, "
                f"sum(CASE WHEN a.grp = 'B' THEN {sb} END) AS sb FROM {o}_a a JOIN {o}_m m ON a.cid = m.cid "
                f"GROUP BY a.cid)")
    ell = " + ".join(f"(m.ma{j} - m.mb{j}) * (m.ma{j} - m.mb{j})" for j in range(d))
    mua = ", ".join(f"coalesce(m.ma{j}, m.mb{j}) AS mua{j}" for j in range(d))
    mub = ", ".join(f"coalesce(m.mb{j}, m.ma{j}) AS mub{j}" for j in range(d))
    ctes.append(
        f"{o}_st AS (SELECT m.cid, m.n_a, m.n_b, tot.na, tot.nb, "
        f"CAST(m.n_a AS DOUBLE) / CAST(tot.na AS DOUBLE) AS alpha, "
        f"CAST(m.n_b AS DOUBLE) / CAST(tot.nb AS DOUBLE) AS beta, "
        f"CASE WHEN m.n_a > 0 AND m.n_b > 0 THEN sqrt({ell}) ELSE 0.0 END AS ell, "
        f"coalesce(s.sa, 0.0) AS d_a, coalesce(s.sb, 0.0) AS d_b, {mua}, {mub} "
        f"FROM {o}_m m JOIN {o}_s s ON m.cid = s.cid "
        f"CROSS JOIN (SELECT sum(n_a) AS na, sum(n_b) AS nb FROM {o}_m) tot)")
    ctes.append(
        f"{o}_f AS (SELECT sum(d_a) / CAST(max(na) AS DOUBLE) AS fa0, sum(d_b) / CAST(max(nb) AS DOUBLE) AS fb0, "
        f"list({{'alpha': alpha, 'beta': beta, 'ell': ell}} ORDER BY cid) AS cl FROM {o}_st)")
    # fA falls and fB grows with γ, so the search over the grid of 1/1024 ends at j/512 where both are
    # equal, else right after the last j/512 at which fA is larger: count those points
    xg = _x("(j.range / 512.0)", "c")
    fa = (f"list_reduce(list_prepend(f.fa0, list_transform(f.cl, lambda c: c.alpha * {xg} * {xg})), "
          f"lambda u, v: u + v)")
    fb = (f"list_reduce(list_prepend(f.fb0, list_transform(f.cl, lambda c: c.beta * (c.ell - {xg}) * (c.ell - {xg}))), "
          f"lambda u, v: u + v)")
    ctes.append(
        f"{o}_g AS (SELECT coalesce(min(k) FILTER (WHERE fa = fb) / 512.0, (2 * count(*) FILTER (WHERE fa > fb) + 1) / 1024.0) AS used "
        f"FROM (SELECT j.range AS k, {fa} AS fa, {fb} AS fb FROM range(1, 512) j CROSS JOIN {o}_f f) z)")
    xu = _x("gu.used", "st")
    newc = ", ".join(f"CASE WHEN st.ell = 0.0 THEN st.mua{j} "
                     f"ELSE ((st.ell - {xu}) * st.mua{j} + {xu} * st.mub{j}) / st.ell END AS c{j}" for j in range(d))
    ctes.append(f"{o}_new AS (SELECT st.cid, {newc}, gu.used AS gamma FROM {o}_st st "
                f"CROSS JOIN {o}_g gu)")
    ctes.append(f"{o}_all AS (SELECT cid, {_cols('c', d)} FROM {o}_new UNION ALL "
                f"SELECT cid, {_cols('c', d)} FROM {cen} WHERE cid NOT IN (SELECT cid FROM {o}_new))")
    return ctes


def lloyd_step_ctes(pts: str, cen: str, d: int, o: str) -> list[str]:
    ctes = assign_ctes(pts, cen, d, f"{o}_a")
    ctes.append(f"{o}_new AS (SELECT cid, {', '.join(f'avg(x{j}) AS c{j}' for j in range(d))} "
                f"FROM {o}_a GROUP BY cid)")
    ctes.append(f"{o}_all AS (SELECT cid, {_cols('c', d)} FROM {o}_new UNION ALL "
                f"SELECT cid, {_cols('c', d)} FROM {cen} WHERE cid NOT IN (SELECT cid FROM {o}_new))")
    return ctes


def seeding_ctes(k: int, seed: int, name: str = "seeds") -> list[str]:
    """``name``: k centres (cid, c0..c2) drawn by the exponential race over the distinct points."""
    ctes = ["dp AS (SELECT x0, x1, x2, count(*) AS n FROM pts GROUP BY ALL)"]
    m = seeding.PRIME
    for r, (a, b) in enumerate(seeding.round_parameters(k, seed)):
        acc = f"{b}"
        for j in range(3):
            grid = f"CAST(floor(x{j} * {dbl(seeding.GRID)}) AS BIGINT)"
            acc = f"(({a} * CAST({acc} AS BIGINT) + (({grid} % {m}) + {m}) % {m}) % {m})"
        u = f"((({a} * {acc} + {b}) % {m} + CAST(0.5 AS DOUBLE)) / CAST({m} AS DOUBLE))"
        weight = "CAST(n AS DOUBLE)" if not r else f"n * (SELECT min({_d2(3, 'dp', 'c')}) FROM {name}{r - 1} c)"
        before = f"SELECT * FROM {name}{r - 1} UNION ALL " if r else ""
        ctes.append(f"{name}{r} AS ({before}SELECT {r} AS cid, x0 AS c0, x1 AS c1, x2 AS c2 FROM (SELECT * FROM (SELECT x0, x1, x2, {u} AS u, "
                    f"{weight} AS w FROM dp) WHERE w > 0 ORDER BY -ln(u) / w, x0, x1, x2 LIMIT 1))")
    return ctes


def centers_out(name: str, d: int, extra: str = "") -> str:
    cols = ", ".join(f"{rnd(f'c{j}')} AS x{j}" for j in range(d))
    return f"SELECT CAST(cid AS BIGINT) AS cid, {cols}{extra} FROM {name}"


# ---------------------------------------------------------------- items and hash families

ITEMS_SKEW = f"it AS (SELECT 10000 // (1 + (event_id * 7919) % 10000) AS item, event_id // {BATCH_SIZE} AS batch FROM events)"
ITEMS_USER = f"it AS (SELECT user_id AS item, event_id // {BATCH_SIZE} AS batch FROM events)"
ITEMS_PART = "it AS (SELECT l_partkey AS item FROM lineitem)"
ITEMS_ORDER = "it AS (SELECT l_orderkey AS item FROM lineitem)"


def _raw(x: str, a: str, b: str, p: int) -> str:
    return f"(({a} * ((({x} % {p}) + {p}) % {p}) + {b}) % {p})"


def family_values(name: str, h: HashFamily, g: HashFamily | None = None) -> str:
    if g is None:
        rows = ", ".join(f"({r}, {a}, {b})" for r, (a, b) in enumerate(zip(h.a, h.b)))
        return f"{name} AS (SELECT * FROM (VALUES {rows}) AS v(r, a, b))"
    rows = ", ".join(f"({r}, {a}, {b}, {ga}, {gb})"
                     for r, (a, b, ga, gb) in enumerate(zip(h.a, h.b, g.a, g.b)))
    return f"{name} AS (SELECT * FROM (VALUES {rows}) AS v(r, a, b, ga, gb))"


def cm_ctes(spec: SketchSpec, items: str = "it", name: str = "cm") -> list[str]:
    h = spec.cm_h
    return [family_values(f"{name}_h", h),
            f"{name} AS (SELECT h.r, {_raw('i.item', 'h.a', 'h.b', h.p)} % {spec.w} AS c, count(*) AS v "
            f"FROM {items} i CROSS JOIN {name}_h h GROUP BY ALL)"]


def cs_ctes(spec: SketchSpec, items: str = "it", name: str = "cs") -> list[str]:
    h, g = spec.cs_h, spec.cs_g
    return [family_values(f"{name}_h", h, g),
            f"{name} AS (SELECT h.r, {_raw('i.item', 'h.a', 'h.b', h.p)} % {spec.w} AS c, "
            f"sum(2 * ({_raw('i.item', 'h.ga', 'h.gb', g.p)} % 2) - 1) AS v "
            f"FROM {items} i CROSS JOIN {name}_h h GROUP BY ALL)"]


def cm_est_ctes(spec: SketchSpec, queries: str, cells: str = "cm", name: str = "cme") -> list[str]:
    h = spec.cm_h
    return [f"{name} AS (SELECT q.item, min(coalesce(x.v, 0)) AS cm_est FROM "
            f"(SELECT q.item, h.r, {_raw('q.item', 'h.a', 'h.b', h.p)} % {spec.w} AS c "
            f"FROM (SELECT DISTINCT item FROM {queries}) q CROSS JOIN {cells}_h h) q "
            f"LEFT JOIN {cells} x ON q.r = x.r AND q.c = x.c GROUP BY q.item)"]


def cs_est_ctes(spec: SketchSpec, queries: str, cells: str = "cs", name: str = "cse") -> list[str]:
    h, g = spec.cs_h, spec.cs_g
    return [f"{name} AS (SELECT q.item, list_sort(list(coalesce(x.v, 0) * q.g))[{spec.d // 2 + 1}] AS cs_est FROM "
            f"(SELECT q.item, h.r, {_raw('q.item', 'h.a', 'h.b', h.p)} % {spec.w} AS c, "
            f"2 * ({_raw('q.item', 'h.ga', 'h.gb', g.p)} % 2) - 1 AS g "
            f"FROM (SELECT DISTINCT item FROM {queries}) q CROSS JOIN {cells}_h h) q "
            f"LEFT JOIN {cells} x ON q.r = x.r AND q.c = x.c GROUP BY q.item)"]


HIST = "hist AS (SELECT item, count(*) AS freq FROM it GROUP BY item)"


def hh_cte(k: int) -> str:
    return f"hh AS (SELECT item, freq FROM hist QUALIFY rank() OVER (ORDER BY freq DESC) <= {k})"


def report_ctes(spec: SketchSpec, k: int) -> list[str]:
    return ([HIST, hh_cte(k)] + cm_ctes(spec) + cs_ctes(spec) + cm_est_ctes(spec, "hh") + cs_est_ctes(spec, "hh")
            + ["rep AS (SELECT hh.item, hh.freq, cme.cm_est, cse.cs_est, "
               "abs(hh.freq - cme.cm_est) / CAST(hh.freq AS DOUBLE) AS cm_err, "
               "abs(hh.freq - cse.cs_est) / CAST(hh.freq AS DOUBLE) AS cs_err "
               "FROM hh JOIN cme ON hh.item = cme.item JOIN cse ON hh.item = cse.item)"])


# ---------------------------------------------------------------- the oracle queries

def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    xs3 = ", ".join(f"{rnd(f'p.x{j}')} AS x{j}" for j in range(3))
    q["points_scan"] = with_ctes([PTS3], f"SELECT {xs3}, p.grp FROM pts p")
    q["points_roundtrip"] = q["points_scan"]
    q["points_quarantine"] = (
        "SELECT grp, CAST(count(*) AS BIGINT) AS n, " + rnd("sum(CASE WHEN length(grp) = 1 THEN l_quantity * l_linenumber ELSE 0 END)")
        + " AS total FROM (SELECT l_quantity, l_linenumber, CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN 'blank line' "
          "WHEN l_linenumber = 2 AND l_returnflag = 'R' THEN 'wrong number of fields' "
          "WHEN l_linenumber IN (3, 4) AND l_returnflag = 'A' THEN 'a coordinate is not a number' WHEN l_linestatus = 'O' THEN 'A' "
          "WHEN l_linenumber = 1 THEN 'a label is neither A nor B' ELSE 'B' END AS grp FROM lineitem) GROUP BY grp")
    q["items_quarantine"] = (
        "SELECT kind, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN kind = 'item' THEN user_id ELSE 0 END) AS BIGINT) AS total, "
        "CAST(count(DISTINCT CASE WHEN kind = 'item' THEN user_id END) AS BIGINT) AS different FROM (SELECT user_id, "
        "CASE WHEN event_id % 97 = 0 THEN 'blank line' WHEN event_id % 89 = 0 THEN 'not an integer' "
        "WHEN event_id % 83 = 0 THEN 'beyond 64 bits' ELSE 'item' END AS kind FROM events) GROUP BY kind")
    q["group_filter"] = with_ctes([PTS3], f"SELECT {xs3}, p.grp FROM pts p WHERE p.grp = 'A'")
    q["group_counts"] = with_ctes([PTS3], "SELECT CAST(count(*) AS BIGINT) AS n, "
                                          "CAST(count(*) FILTER (WHERE grp = 'A') AS BIGINT) AS n_a, "
                                          "CAST(count(*) FILTER (WHERE grp = 'B') AS BIGINT) AS n_b FROM pts")
    dists = ", ".join(f"{rnd('sqrt(' + ' + '.join(f'(p.x{j} - {dbl(v)}) * (p.x{j} - {dbl(v)})' for j, v in enumerate(c)) + ')')} AS dist_{i}"
                      for i, c in enumerate(P.CENTERS_PTS3))
    q["point_distance"] = with_ctes([PTS3], f"SELECT {xs3}, p.grp, {dists} FROM pts p")
    q["min_sq_distance"] = with_ctes([PTS3], f"SELECT {xs3}, p.grp, {rnd(min_d2_expr(P.CENTERS_PTS3))} AS d2 FROM pts p")
    q["nearest_center"] = with_ctes([PTS3, CEN3] + assign_ctes("pts", "cen", 3, "asg"),
                                    f"SELECT {xs3}, p.grp, CAST(p.cid AS BIGINT) AS cid, {rnd('p.d2')} AS d2 FROM asg p")
    q["cluster_members"] = q["nearest_center"] + f" WHERE p.cid = {P.MEMBERS_OF}"
    q["standard_objective"] = with_ctes([PTS3], f"SELECT {rnd('avg(' + min_d2_expr(P.CENTERS_PTS3) + ')')} AS delta FROM pts p")
    q["standard_objective_distinct"] = with_ctes(
        [PTS3], f"SELECT {rnd('sum(' + min_d2_expr(P.CENTERS_PTS3) + ') / (SELECT count(*) FROM pts)')} AS delta "
                f"FROM (SELECT DISTINCT x0, x1, x2 FROM pts) p")
    q["distinct_points"] = with_ctes([PTS3], f"SELECT {xs3}, CAST(count(*) AS BIGINT) AS n FROM pts p GROUP BY p.x0, p.x1, p.x2")
    q["group_objectives"] = with_ctes(
        [PTS3], f"SELECT grp, CAST(count(*) AS BIGINT) AS n, {rnd('sum(' + min_d2_expr(P.CENTERS_PTS3) + ')')} AS sum_d2, "
                f"{rnd('avg(' + min_d2_expr(P.CENTERS_PTS3) + ')')} AS mean_d2 FROM pts p GROUP BY grp")
    fair_obj = ("SELECT {a} AS phi_a, {b} AS phi_b, {m} AS phi FROM (SELECT "
                "avg(d2) FILTER (WHERE grp = 'A') AS pa, avg(d2) FILTER (WHERE grp = 'B') AS pb FROM {src}) z")
    fo = fair_obj.format(a=rnd("pa"), b=rnd("pb"), m=rnd("greatest(pa, pb)"), src="{src}")
    q["fair_objective"] = with_ctes([PTS3, f"dd AS (SELECT grp, {min_d2_expr(P.CENTERS_PTS3)} AS d2 FROM pts p)"],
                                    fo.format(src="dd"))
    q["cluster_group_counts"] = with_ctes(
        [PTS3, CEN3] + assign_ctes("pts", "cen", 3, "asg"),
        "SELECT CAST(a.cid AS BIGINT) AS cid, any_value(c.c0) AS x0, any_value(c.c1) AS x1, any_value(c.c2) AS x2, "
        "CAST(count(*) FILTER (WHERE grp = 'A') AS BIGINT) AS n_a, "
        "CAST(count(*) FILTER (WHERE grp = 'B') AS BIGINT) AS n_b FROM asg a JOIN cen c ON a.cid = c.cid GROUP BY a.cid")
    cells3 = ("cen AS (SELECT p_partkey AS cid, p_size / CAST(50 AS DOUBLE) AS c0, p_partkey * 37 % 101 / CAST(100 AS DOUBLE) AS c1, "
              "p_partkey * 53 % 81 / CAST(100 AS DOUBLE) AS c2 FROM part)")
    each = "one AS (SELECT x0, x1, x2, count(*) AS n, row_number() OVER () AS pid FROM pts GROUP BY ALL)"
    q["nearest_part"] = with_ctes(
        [PTS3, cells3, each] + assign_ctes("one", "cen", 3, "asg"),
        f"SELECT CAST(cid AS BIGINT) AS cid, CAST(sum(n) AS BIGINT) AS n, {rnd('sum(n * d2)')} AS sum_d2 FROM asg GROUP BY cid")
    q["nearest_part_skipped"] = ("SELECT CAST((SELECT count(*) FROM lineitem) AS BIGINT) AS n_points, "
                                 "CAST(count(*) AS BIGINT) AS n_centers, true AS nine_tenths_skipped FROM part")
    q["nearest_center_emb"] = with_ctes(
        [EMB, EMB_CENTERS] + assign_ctes("pts", "cen", 64, "asg"),
        f"SELECT CAST(cid AS BIGINT) AS cid, CAST(count(*) AS BIGINT) AS n, "
        f"CAST(count(*) FILTER (WHERE grp = 'A') AS BIGINT) AS n_a, "
        f"CAST(count(*) FILTER (WHERE grp = 'B') AS BIGINT) AS n_b, {rnd('sum(d2)')} AS sum_d2 FROM asg GROUP BY cid")
    q["fair_objective_emb"] = with_ctes([EMB, EMB_CENTERS] + assign_ctes("pts", "cen", 64, "asg"),
                                        fo.format(src="asg"))

    # fair k-means
    fs = fair_step_ctes("pts", "cen", 3, "s1")
    mua = ", ".join(f"{rnd(f'mua{j}')} AS mu_a{j}" for j in range(3))
    mub = ", ".join(f"{rnd(f'mub{j}')} AS mu_b{j}" for j in range(3))
    q["fair_cluster_stats"] = with_ctes(
        [PTS3, CEN3] + fs,
        f"SELECT CAST(cid AS BIGINT) AS cid, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, "
        f"{rnd('alpha')} AS alpha, {rnd('beta')} AS beta, {rnd('ell')} AS ell, {rnd('d_a')} AS d_a, "
        f"{rnd('d_b')} AS d_b, {mua}, {mub} FROM s1_st")
    q["fair_fixed_terms"] = with_ctes(
        [PTS3, CEN3] + fs, f"SELECT {rnd('fa0')} AS fixed_a, {rnd('fb0')} AS fixed_b, "
                           f"CAST(len(cl) AS BIGINT) AS n_clusters FROM s1_f")
    q["fair_balance"] = with_ctes(
        [PTS3, CEN3] + fs,
        f"SELECT {rnd('gu.used')} AS gamma, CAST(st.cid AS BIGINT) AS cid, {rnd(_x('gu.used', 'st'))} AS x "
        f"FROM s1_st st CROSS JOIN s1_g gu")
    q["fair_step"] = with_ctes([PTS3, CEN3] + fs, centers_out("s1_new", 3, f", {rnd('gamma')} AS gamma"))
    q["fair_step_emb"] = with_ctes([EMB, EMB_CENTERS] + fair_step_ctes("pts", "cen", 64, "s1"),
                                   centers_out("s1_new", 64, f", {rnd('gamma')} AS gamma"))
    def loop(step, n, tag):
        steps, prev = [], "cen"
        for m in range(1, n + 1):
            steps += step("pts", prev, 3, f"{tag}{m}")
            prev = f"{tag}{m}_all"
        return steps, prev

    for n, fair_name, lloyd_name in ((P.LOOP_STEPS, "fair_kmeans_fixed_start", "lloyd_fixed_start"),
                                     (P.CACHED_LOOP_STEPS, "fair_kmeans_cached_loop", "lloyd_cached_loop")):
        for name, step in ((fair_name, fair_step_ctes), (lloyd_name, lloyd_step_ctes)):
            steps, last = loop(step, n, "s")
            q[name] = with_ctes([PTS3, CEN3] + steps, centers_out(last, 3))
    lloyd, l_last = loop(lloyd_step_ctes, P.LOOP_STEPS, "l")
    fairs, f_last = loop(fair_step_ctes, P.LOOP_STEPS, "f")
    phis = " UNION ALL ".join(
        f"SELECT '{name}' AS method, {rnd('pa')} AS phi_a, {rnd('pb')} AS phi_b, {rnd('greatest(pa, pb)')} AS phi FROM "
        f"(SELECT avg(d2) FILTER (WHERE grp = 'A') AS pa, avg(d2) FILTER (WHERE grp = 'B') AS pb FROM {src}) z"
        for name, src in (("standard", "za"), ("fair", "zb")))
    q["fair_vs_standard"] = with_ctes([PTS3, CEN3] + lloyd + fairs + assign_ctes("pts", l_last, 3, "za")
                                      + assign_ctes("pts", f_last, 3, "zb"), phis)
    steps = []
    for r, cs in P.SWEEP_STARTS.items():
        steps += [centers_values(cs, f"cen{r}"), *fair_step_ctes("pts", f"cen{r}", 3, f"r{r}")]
    q["fair_sweep"] = with_ctes([PTS3] + steps, " UNION ALL ".join(
        centers_out(f"r{r}_new", 3, f", {rnd('gamma')} AS gamma, CAST({r} AS BIGINT) AS run_id") for r in P.SWEEP_STARTS))
    steps, phis = [], []
    for r, cs in P.SWEEP_STARTS.items():
        steps.append(centers_values(cs, f"cen{r}"))
        last = f"cen{r}"
        for m in range(P.LOOP_STEPS):
            steps += fair_step_ctes("pts", last, 3, f"r{r}_{m}")
            last = f"r{r}_{m}_all"
        steps += assign_ctes("pts", last, 3, f"z{r}")
        phis.append(f"SELECT {r} AS run_id, avg(d2) FILTER (WHERE grp = 'A') AS pa, avg(d2) FILTER (WHERE grp = 'B') AS pb FROM z{r}")
    q["fair_sweep_best"] = with_ctes(
        [PTS3] + steps + [f"phis AS ({' UNION ALL '.join(phis)})"],
        f"SELECT CAST(run_id AS BIGINT) AS run_id, {rnd('pa')} AS phi_a, {rnd('pb')} AS phi_b, {rnd('greatest(pa, pb)')} AS phi, "
        "run_id = (SELECT run_id FROM phis ORDER BY greatest(pa, pb), run_id LIMIT 1) AS best FROM phis")
    # repeating the coordinates times 1, 2, ... multiplies every squared distance by the sum of squares
    scale = sum(k * k for k in range(1, P.WIDE_REPEATS + 1))
    q["fair_cluster_stats_wide"] = with_ctes(
        [EMB, EMB_CENTERS] + fair_step_ctes("pts", "cen", 64, "s1"),
        f"SELECT CAST(cid AS BIGINT) AS cid, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, {rnd('alpha')} AS alpha, "
        f"{rnd('beta')} AS beta, {rnd(f'sqrt({dbl(scale)}) * ell')} AS ell, {rnd(f'{dbl(scale)} * d_a')} AS d_a, "
        f"{rnd(f'{dbl(scale)} * d_b')} AS d_b FROM s1_st")
    seeds = seeding_ctes(P.KMEANS_K, P.SEEDING_SEED)
    start = f"seeds{P.KMEANS_K - 1}"
    q["seeding"] = with_ctes([PTS3] + seeds, centers_out(start, 3))
    steps, last = [], start
    for m in range(P.LOOP_STEPS):
        steps += lloyd_step_ctes("pts", last, 3, f"k{m}")
        last = f"k{m}_all"
    q["kmeans_seeded"] = with_ctes([PTS3] + seeds + steps, centers_out(last, 3))
    mean = " + ".join(f"var_pop(x{j})" for j in range(3))
    q["kmeans_standard"] = with_ctes(
        [PTS3], f"SELECT CAST(count(*) AS BIGINT) AS n_points, CAST({P.KMEANS_K} AS BIGINT) AS n_centers, "
                f"{rnd(mean)} AS delta_of_mean, true AS below_mean, true AS not_above_seeding FROM pts")
    gapped = ", ".join(f"({i}, {', '.join(dbl(v) for v in c)})" for i, c in P.GAPPED_CENTERS)
    q["nearest_center_gapped_ids"] = with_ctes(
        [PTS3, f"cen AS (SELECT * FROM (VALUES {gapped}) AS v(cid, c0, c1, c2))"] + assign_ctes("pts", "cen", 3, "asg"),
        f"SELECT {xs3}, p.grp, CAST(p.cid AS BIGINT) AS cid, {rnd('p.d2')} AS d2 FROM asg p")
    q["points_csv_fixed"] = q["points_scan"]

    # sketches and heavy hitters
    q["item_frequencies"] = with_ctes([ITEMS_SKEW], "SELECT item, CAST(count(*) AS BIGINT) AS freq FROM it GROUP BY item")
    q["stream_totals"] = with_ctes([ITEMS_SKEW], "SELECT CAST(count(*) AS BIGINT) AS n_items, "
                                                 "CAST(count(DISTINCT item) AS BIGINT) AS n_distinct FROM it")
    w = P.SPEC_WIDE
    q["hash_buckets"] = with_ctes(
        [ITEMS_ORDER, family_values("h", w.cm_h)],
        f"SELECT i.item, CAST(h.r AS BIGINT) AS r, CAST({_raw('i.item', 'h.a', 'h.b', w.cm_h.p)} % {w.w} AS BIGINT) AS c "
        f"FROM (SELECT DISTINCT item FROM it) i CROSS JOIN h")
    q["hash_signs"] = with_ctes(
        [ITEMS_ORDER, family_values("h", w.cs_g)],
        f"SELECT i.item, CAST(h.r AS BIGINT) AS r, CAST(2 * ({_raw('i.item', 'h.a', 'h.b', w.cs_g.p)} % 2) - 1 AS BIGINT) AS g "
        f"FROM (SELECT DISTINCT item FROM it) i CROSS JOIN h")
    cells_out = "SELECT CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, CAST(v AS BIGINT) AS v FROM {}"
    q["cm_cells"] = with_ctes([ITEMS_ORDER] + cm_ctes(w), cells_out.format("cm"))
    q["cs_cells"] = with_ctes([ITEMS_ORDER] + cs_ctes(w), cells_out.format("cs"))
    q["cm_estimate"] = with_ctes([ITEMS_PART] + cm_ctes(w) + cm_est_ctes(w, "it"),
                                 "SELECT item, CAST(cm_est AS BIGINT) AS cm_est FROM cme")
    q["cs_estimate"] = with_ctes([ITEMS_PART] + cs_ctes(w) + cs_est_ctes(w, "it"),
                                 "SELECT item, CAST(cs_est AS BIGINT) AS cs_est FROM cse")
    q["heavy_hitters"] = with_ctes([ITEMS_SKEW, HIST, hh_cte(P.TOP_K)],
                                   "SELECT item, CAST(freq AS BIGINT) AS freq FROM hh")
    q["heavy_hitters_users"] = with_ctes([ITEMS_USER, HIST, hh_cte(P.TOP_K_USERS)],
                                         "SELECT item, CAST(freq AS BIGINT) AS freq FROM hh")
    rep_out = (f"SELECT item, CAST(freq AS BIGINT) AS freq, CAST(cm_est AS BIGINT) AS cm_est, "
               f"CAST(cs_est AS BIGINT) AS cs_est, {rnd('cm_err')} AS cm_err, {rnd('cs_err')} AS cs_err FROM rep")
    n = P.SPEC_NARROW
    q["heavy_hitter_detail"] = with_ctes([ITEMS_SKEW] + report_ctes(n, P.TOP_K), rep_out)
    acc_out = (f"SELECT CAST(count(*) AS BIGINT) AS n_hh, {rnd('avg(cm_err)')} AS cm_avg_err, "
               f"{rnd('avg(cs_err)')} AS cs_avg_err FROM rep")
    q["sketch_accuracy"] = with_ctes([ITEMS_ORDER] + report_ctes(w, P.TOP_K_ORDERS), acc_out)
    q["order_frequencies"] = with_ctes([ITEMS_ORDER], "SELECT item, CAST(count(*) AS BIGINT) AS freq FROM it GROUP BY item")
    q["heavy_hitters_orders"] = with_ctes([ITEMS_ORDER, HIST, hh_cte(P.TOP_K_ORDERS)],
                                          "SELECT item, CAST(freq AS BIGINT) AS freq FROM hh")
    q["cm_merge"] = with_ctes([ITEMS_ORDER] + cm_ctes(w), cells_out.format("cm"))

    big = P.SPEC_LARGE
    q["cm_estimate_shuffled"] = with_ctes([ITEMS_ORDER] + cm_ctes(big) + cm_est_ctes(big, "it"),
                                          "SELECT item, CAST(cm_est AS BIGINT) AS cm_est FROM cme")
    q["heavy_hitters_by_batch"] = with_ctes(
        [ITEMS_SKEW], "SELECT CAST(batch AS BIGINT) AS batch, item, CAST(count(*) AS BIGINT) AS freq FROM it GROUP BY batch, item "
                      f"QUALIFY rank() OVER (PARTITION BY batch ORDER BY count(*) DESC) <= {P.TOP_K_BATCH}")
    q["sketch_store"] = q["cm_cells"]
    q["sketch_store_years"] = with_ctes(
        [f"it AS (SELECT l_orderkey AS item FROM (SELECT *, year(l_shipdate) AS batch FROM lineitem) WHERE {P.STORE_YEARS})"] + cm_ctes(w),
        cells_out.format("cm"))

    # streams (the stream is the whole events table; the oracle is the batch computation)
    q["stream_prefix"] = with_ctes(
        [ITEMS_SKEW, "sizes AS (SELECT batch, count(*) AS n FROM it GROUP BY batch)",
         "run AS (SELECT batch, coalesce(sum(n) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sizes)"],
        f"SELECT CAST(count(*) AS BIGINT) AS n_items, CAST(count(DISTINCT item) AS BIGINT) AS n_distinct, "
        f"CAST(max(batch) AS BIGINT) AS last_batch FROM it WHERE batch IN (SELECT batch FROM run WHERE before < {P.STREAM_T})")
    q["stream_histogram"] = q["item_frequencies"]
    q["stream_cm_cells"] = with_ctes([ITEMS_SKEW] + cm_ctes(n), cells_out.format("cm"))
    q["stream_cs_cells"] = with_ctes([ITEMS_SKEW] + cs_ctes(n), cells_out.format("cs"))
    q["stream_report"] = with_ctes(
        [ITEMS_SKEW] + report_ctes(n, P.TOP_K),
        f"SELECT (SELECT CAST(count(*) AS BIGINT) FROM it) AS n_items, "
        f"(SELECT CAST(count(*) AS BIGINT) FROM hist) AS n_distinct, "
        f"CAST(count(*) AS BIGINT) AS n_hh, {rnd('avg(cm_err)')} AS cm_avg_err, {rnd('avg(cs_err)')} AS cs_avg_err FROM rep")
    arrivals = ("it AS (SELECT user_id AS item, 0 AS batch FROM events UNION ALL SELECT o_custkey, 1 FROM orders "
                "UNION ALL SELECT l_partkey, 2 FROM lineitem)")
    counts = "SELECT item, CAST(count(*) AS BIGINT) AS freq FROM it {}GROUP BY item"
    q["stream_tables_histogram"] = with_ctes([arrivals], counts.format(""))
    q["stream_tables_cm_cells"] = with_ctes([arrivals] + cm_ctes(n), cells_out.format("cm"))
    q["stream_tables_cs_cells"] = with_ctes([arrivals] + cs_ctes(n), cells_out.format("cs"))
    q["stream_tables_until"] = with_ctes(
        [arrivals], counts.format(f"i WHERE (SELECT count(*) FROM it e WHERE e.batch < i.batch) < {P.STREAM_T_TABLES} "))
    # the events table is one file, hence one batch, and a batch is taken whole
    q["stream_report_t"] = q["stream_report"]
    return q


ORACLE_SQL: dict[str, str] = _sql()
