"""Distance on the WGS-84 ellipsoid as native column expressions.

Vincenty's inverse formula (Survey Review, 1975) with a fixed number of
iterations, written as a chain of projections so the whole computation
stays inside whole-stage code generation: no Python worker, no per-row
serialisation.  Each iteration is two projections; Catalyst does not
inline a non-trivial column that is used twice, so the plan grows linearly
with the iteration count, and within a projection the generated code
evaluates repeated subexpressions once.

Accuracy: for points up to a few thousand kilometres apart six iterations
agree with the converged value far below a millimetre.  Rows whose last step
still moved the longitude difference by more than ``TOLERANCE``, and all more
than ``FAR`` apart (points nearly opposite each other on the globe, for which
that formula converges slowly or not at all) are solved by their azimuth instead (Karney,
"Algorithms for geodesics", 2013): the longitude reached at the second
point's latitude grows with the azimuth at the first, so the half circle of
azimuths brackets it.  ``QUICK`` steps of inverse quadratic interpolation
(Chandrupatla, 1997) settle nearly all rows, most in about ten; ``HALVINGS``
halvings of what is left pin it down whatever the points.  The longitude is a
series in the third flattening, the length a Gauss-Legendre sum of ``NODES``
terms.  That is one fold over a literal array, evaluated for those rows only;
the result is good to well below a millimetre for every pair of points.  The
fold is a projection of its own after the fused chain, interpreted row by row:
rows that need it should be spread over the tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from blotter.functions._cols import ColumnOrName, as_col

# WGS-84 semi-major axis (metres) and flattening.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_B = (1 - WGS84_F) * WGS84_A
DEFAULT_ITERATIONS = 6
MAX_ITERATIONS = 20  # the projections of one row must fit one generated method
TOLERANCE = 1e-11  # radians, less than a tenth of a millimetre on the ground
FAR = 3.0  # radians of arc beyond which the series, too, lose their last digits
QUICK = 24  # steps by interpolation
HALVINGS = 56  # of the half circle of azimuths, down to the last bit of a double
SAME = 1e-15  # radians of longitude: nanometres
NODES = 12

_P = "__geo_"


def _d(x: float) -> str:
    """SQL double literal holding exactly the Python float ``x``."""
    return f"{float(x)!r}D"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _line(alpha: str, p: str) -> str:
    """The line that leaves the first point at azimuth ``alpha``, up to the latitude of the second.

    ``p`` names a struct of sines and cosines of the reduced latitudes (sb1,
    cb1, sb2, cb2; the first point is the one farther from the equator, on the
    southern side).  Result: the longitude passed, the sine of the azimuth at
    the equator, and the arcs and the parameter k2 that give the length.
    """
    # cos(b2)^2 - cos(b1)^2, from whichever of sine and cosine loses fewer digits
    apart = (
        f"CASE WHEN {p}.cb1 < -{p}.sb1 THEN ({p}.cb2 - {p}.cb1) * ({p}.cb2 + {p}.cb1) "
        f"ELSE ({p}.sb1 - {p}.sb2) * ({p}.sb1 + {p}.sb2) END"
    )
    start = f"named_struct('s', sin({alpha}) * {p}.cb1, 'c', cos({alpha}) * {p}.cb1)"
    # Spark's atan2 knows no negative zero: on the equator going south is half a turn back
    back = f"CASE WHEN {p}.sb1 = 0 AND a.c < 0 THEN -pi() ELSE"
    ends = (
        f"named_struct('s', a.s, 'o1', {back} atan2({p}.sb1, a.c) END, 'o2', atan2({p}.sb2, e), "
        f"'w', atan2(a.s * {p}.sb2, e) - ({back} atan2(a.s * {p}.sb1, a.c) END), "
        f"'k2', {_d(WGS84_A**2 / WGS84_B**2 - 1)} * ({_d(1.0)} - a.s * a.s))"
    )
    ends = _let("e", f"sqrt(greatest({_d(0.0)}, a.c * a.c + {apart}))", ends)
    passed = f"named_struct('lon', q.w - {_d(WGS84_F)} * q.s * {_slower('q')}, 's', q.s, 'o1', q.o1, 'o2', q.o2, 'k2', q.k2)"
    return _let("a", start, _let("q", ends, passed))


def _slower(q: str) -> str:
    """Karney's I3 from ``q.o1`` to ``q.o2`` (equations 23 to 25), to some 1e-15 of the longitude.

    The integral of (2 - f) / (1 + (1 - f) sqrt(1 + k2 sin(x)^2)).
    """
    n = WGS84_F / (2 - WGS84_F)

    def series(*terms: float) -> str:
        out = _d(terms[-1])
        for c in terms[-2::-1]:
            out = f"({_d(c)} + h.e * {out})"
        return out

    a3 = series(1, n / 2 - 1 / 2, 3 / 8 * n * n - n / 8 - 1 / 4, -(1 + 3 * n + n * n) / 16, -3 / 64 - n / 32)
    c1 = series(0, (1 - n) / 4, (1 - n * n) / 8, (3 + 3 * n - n * n) / 64, 5 / 128 + n / 64)
    c2 = series(0, 0, 1 / 16 - 3 / 32 * n + n * n / 32, 3 / 64 - n / 32 - 3 / 64 * n * n)
    c3 = series(0, 0, 0, 5 / 192 - 3 / 64 * n + 5 / 192 * n * n)
    halves = (
        f"named_struct('e', {q}.k2 / (2 * (1 + sqrt(1 + {q}.k2)) + {q}.k2), 's1', sin(2 * {q}.o1), "
        f"'d1', 2 * cos(2 * {q}.o1), 's2', sin(2 * {q}.o2), 'd2', 2 * cos(2 * {q}.o2))"
    )
    waves = (
        f"{c1} * (h.s2 - h.s1) + {c2} * (h.s2 * h.d2 - h.s1 * h.d1) "
        f"+ {c3} * (h.s2 * (h.d2 * h.d2 - 1) - h.s1 * (h.d1 * h.d1 - 1))"
    )
    return _let("h", halves, f"{a3} * ({q}.o2 - {q}.o1 + {waves})")


def _integral(q: str, term: str) -> str:
    """The integral of ``term`` (in ``x``) from ``q.o1`` to ``q.o2``."""
    at, weight = np.polynomial.legendre.leggauss(NODES)
    nodes = ", ".join(f"named_struct('x', {_d(x)}, 'w', {_d(w)})" for x, w in zip(at, weight))
    middle = f"({q}.o2 + {q}.o1) / 2 + ({q}.o2 - {q}.o1) / 2 * g.x"
    summed = f"aggregate(array({nodes}), {_d(0.0)}, (acc, g) -> acc + g.w * {_let('x', middle, term)})"
    return f"(({q}.o2 - {q}.o1) / 2 * {summed})"


def _step() -> str:
    """One step of the search in state ``s``: the azimuth is between x1, tried last, and x2.

    f1 and f2 are the longitudes missed there, of different signs; x3 is the
    point that x1 or x2 took the place of.  The next one is tried at the share t
    of the way from x1 to x2; 0 ends the search.
    """
    tried = "s.x1 + s.t * (s.x2 - s.x1)"
    missed = _let("x", tried, f"named_struct('x', x, 'f', {_line('x', 'p')}.lon - p.lon)")
    bracket = (
        "CASE WHEN (v.f < 0) = (s.f1 < 0) "
        "THEN named_struct('x1', v.x, 'f1', v.f, 'x2', s.x2, 'f2', s.f2, 'x3', s.x1, 'f3', s.f1) "
        "ELSE named_struct('x1', v.x, 'f1', v.f, 'x2', s.x1, 'f2', s.f1, 'x3', s.x2, 'f3', s.f2) END"
    )
    least = f"({_d(2.0**-52)} * abs(n.x1) + {_d(np.pi / 2**HALVINGS)})"
    # inverse quadratic interpolation, where the three points rise evenly enough
    ratio = "named_struct('xi', (n.x1 - n.x2) / (n.x3 - n.x2), 'phi', (n.f1 - n.f2) / (n.f3 - n.f2))"
    even = "1 - sqrt(1 - r.xi) < r.phi AND r.phi < sqrt(r.xi)"
    inverse = (
        "n.f1 / (n.f1 - n.f2) * (n.f3 / (n.f3 - n.f2)) "
        "- (n.x3 - n.x1) / (n.x2 - n.x1) * (n.f1 / (n.f3 - n.f1)) * (n.f2 / (n.f2 - n.f3))"
    )
    margin = f"least({_d(0.5)}, {least} / abs(n.x2 - n.x1))"
    inside = _let("m", margin, f"greatest(m, least(1 - m, {inverse}))")
    share = _let("r", ratio, f"CASE WHEN {even} THEN {inside} ELSE {_d(0.5)} END")
    share = (
        f"CASE WHEN abs(n.f1) <= {_d(SAME)} OR abs(n.x2 - n.x1) <= {least} THEN {_d(0.0)} "
        f"WHEN k <= {QUICK} THEN {share} ELSE {_d(0.5)} END"
    )
    state = f"named_struct({', '.join(f"'{c}', n.{c}" for c in ('x1', 'f1', 'x2', 'f2', 'x3', 'f3'))}, 't', {share})"
    return _let("v", missed, _let("n", bracket, state))


def _metres_by_azimuth(sU1: str, cU1: str, sU2: str, cU2: str, lon: str) -> str:
    """SQL for the length of the shortest line, from the reduced latitudes and the longitude difference."""
    # the point farther from the equator first, mirrored to the south
    swap = f"abs({sU1}) < abs({sU2})"
    side = f"CASE WHEN {swap} THEN {sU2} ELSE {sU1} END"
    other = f"CASE WHEN {swap} THEN {sU1} ELSE {sU2} END"
    point = (
        f"named_struct('sb1', -abs({side}), 'cb1', CASE WHEN {swap} THEN {cU2} ELSE {cU1} END, "
        f"'sb2', CASE WHEN {side} > 0 THEN -({other}) ELSE {other} END, "
        f"'cb2', CASE WHEN {swap} THEN {cU1} ELSE {cU2} END, 'lon', abs({lon}))"
    )
    found = (
        f"aggregate(sequence(1, {QUICK + HALVINGS}), named_struct('x1', {_d(0.0)}, 'f1', -p.lon - {_d(SAME)}, "
        f"'x2', pi(), 'f2', pi() - p.lon + {_d(SAME)}, 'x3', {_d(0.0)}, 'f3', {_d(0.0)}, 't', {_d(0.5)}), "
        f"(s, k) -> CASE WHEN s.t = 0 THEN s ELSE {_step()} END, s -> CASE WHEN abs(s.f1) <= abs(s.f2) THEN s.x1 ELSE s.x2 END)"
    )
    length = f"{_d(WGS84_B)} * " + _integral("r", "sqrt(1 + r.k2 * pow(sin(x), 2))")
    # what the azimuth's last bit leaves of the longitude, along the parallel (much only beside the equator)
    length += f" + {_d(WGS84_A)} * r.s * (p.lon - r.lon)"
    by_line = _let("r", _line("z", "p"), length)
    # on the equator itself the line follows the equator as far as it is the shortest
    along = f"p.sb1 = 0 AND p.sb2 = 0 AND p.lon <= {_d((1 - WGS84_F) * np.pi)}"
    return _let("p", point, f"CASE WHEN {along} THEN {_d(WGS84_A)} * p.lon ELSE {_let('z', found, by_line)} END")


def with_geodesic_km(
    df: DataFrame,
    lat1: ColumnOrName,
    lon1: ColumnOrName,
    lat2: ColumnOrName,
    lon2: ColumnOrName,
    out: str = "distance_km",
    iterations: int = DEFAULT_ITERATIONS,
) -> DataFrame:
    """Add column ``out``: ellipsoidal distance in km between two points in degrees.

    Any NULL coordinate gives NULL; equal points give 0.
    """
    if not 1 <= iterations <= MAX_ITERATIONS:
        raise ValueError(f"iterations must be between 1 and {MAX_ITERATIONS}")
    f = _d(WGS84_F)
    keep = [_q(c) for c in df.columns]
    # Steps are SQL expression text: one parse per step instead of one
    # client call per arithmetic node.  Repeated subexpressions inside one
    # projection are evaluated once by the generated code.
    work = df.select(
        "*",
        as_col(lat1).cast("double").alias(_P + "lat1"),
        as_col(lon1).cast("double").alias(_P + "lon1"),
        as_col(lat2).cast("double").alias(_P + "lat2"),
        as_col(lon2).cast("double").alias(_P + "lon2"),
    )
    u1 = f"atan({_d(1 - WGS84_F)} * tan(radians({_P}lat1)))"
    u2 = f"atan({_d(1 - WGS84_F)} * tan(radians({_P}lat2)))"
    # the short way round; differences within half a turn stay as they are
    turn = f"({_P}lon2 - {_P}lon1)"
    lon_diff = f"radians(CASE WHEN abs{turn} <= 180 THEN {turn} ELSE pmod({turn} + 180, 360) - 180 END)"
    work = work.selectExpr(
        *keep,
        f"{lon_diff} AS {_P}L",
        f"sin({u1}) AS {_P}sU1",
        f"cos({u1}) AS {_P}cU1",
        f"sin({u2}) AS {_P}sU2",
        f"cos({u2}) AS {_P}cU2",
        f"{lon_diff} AS {_P}lam",
    )
    L, sU1, cU1, sU2, cU2 = (f"{_P}{n}" for n in ("L", "sU1", "cU1", "sU2", "cU2"))
    consts = [L, sU1, cU1, sU2, cU2]
    lam, ss, cs, sig, sa, c2a, c2sm = (f"{_P}{n}" for n in ("lam", "ss", "cs", "sig", "sa", "c2a", "c2sm"))
    before = _P + "before"
    for _ in range(iterations):
        # step 1: the auxiliary sphere at the current longitude difference
        sl, cl = f"sin({lam})", f"cos({lam})"
        ss_e = f"sqrt(pow({cU2} * {sl}, 2) + pow({cU1} * {sU2} - {sU1} * {cU2} * {cl}, 2))"
        cs_e = f"({sU1} * {sU2} + {cU1} * {cU2} * {cl})"
        work = work.selectExpr(
            *keep,
            *consts,
            lam,
            f"{ss_e} AS {ss}",
            f"{cs_e} AS {cs}",
            f"atan2({ss_e}, {cs_e}) AS {sig}",
            f"CASE WHEN {ss_e} = 0 THEN {_d(0.0)} ELSE {cU1} * {cU2} * {sl} / {ss_e} END AS {sa}",
        )
        # step 2: the next longitude difference on the auxiliary sphere
        c2a_e = f"({_d(1.0)} - {sa} * {sa})"
        c2sm_e = f"(CASE WHEN {c2a_e} = 0 THEN {_d(0.0)} ELSE {cs} - {_d(2.0)} * {sU1} * {sU2} / {c2a_e} END)"
        big_c = f"({_d(WGS84_F / 16)} * {c2a_e} * ({_d(4.0)} + {f} * ({_d(4.0)} - {_d(3.0)} * {c2a_e})))"
        lam_e = (
            f"{L} + ({_d(1.0)} - {big_c}) * {f} * {sa} * ({sig} + {big_c} * {ss} * "
            f"({c2sm_e} + {big_c} * {cs} * ({_d(-1.0)} + {_d(2.0)} * {c2sm_e} * {c2sm_e})))"
        )
        work = work.selectExpr(
            *keep, *consts, ss, cs, sig, f"{c2a_e} AS {c2a}", f"{c2sm_e} AS {c2sm}", f"{lam} AS {before}", f"{lam_e} AS {lam}"
        )
    usq = f"({c2a} * {_d((WGS84_A**2 - WGS84_B**2) / WGS84_B**2)})"
    big_a = (
        f"({_d(1.0)} + {usq} / 16384 * ({_d(4096.0)} + {usq} * ({_d(-768.0)} + {usq} * "
        f"({_d(320.0)} - {_d(175.0)} * {usq}))))"
    )
    big_b = f"({usq} / 1024 * ({_d(256.0)} + {usq} * ({_d(-128.0)} + {usq} * ({_d(74.0)} - {_d(47.0)} * {usq}))))"
    delta = (
        f"({big_b} * {ss} * ({c2sm} + {big_b} / 4 * ({cs} * ({_d(-1.0)} + {_d(2.0)} * {c2sm} * {c2sm}) "
        f"- {big_b} / 6 * {c2sm} * ({_d(-3.0)} + {_d(4.0)} * {ss} * {ss}) * ({_d(-3.0)} + {_d(4.0)} * {c2sm} * {c2sm}))))"
    )
    distance = f"{_d(WGS84_B / 1000.0)} * {big_a} * ({sig} - {delta})"
    # NULL coordinates and such that are no number give no distance either way
    settled = f"abs({lam} - {before}) <= {_d(TOLERANCE)} AND abs({lam}) <= pi() AND {sig} <= {_d(FAR)}"
    known = f"{L} IS NOT NULL AND {sU1} IS NOT NULL AND {sU2} IS NOT NULL"
    # The search is a fold, which Spark runs outside of the fused stage: a projection of its own, after all others.
    km = _P + "km"
    work = work.selectExpr(*keep, *consts, f"CASE WHEN {settled} THEN {distance} END AS {km}")
    slow = f"{_metres_by_azimuth(sU1, cU1, sU2, cU2, L)} / 1000"
    return work.selectExpr(
        *keep, f"CASE WHEN {km} IS NOT NULL THEN {km} WHEN {known} THEN {slow} END AS {_q(out)}"
    )
