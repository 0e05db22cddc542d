"""Censored-lifetime (Weibull) analysis on the cumulative-hazard method.

Pipeline: ``classify_event`` → ``hazard_table`` (one row per distinct
CYCLE: rows n, failures d, average descending rank, hazard, H) →
``weibull_points`` (per failure row) / ``weibull_fit`` (one row) →
``weibull_fit_line`` / ``weibull_segmented_fit`` → ``weibull_parameter_table``.

Scale notes: everything before the fit is a group-by on CYCLE (partial
aggregation first, so a hot CYCLE value is one row after the map side),
then two bucketed running sums (``prefix.running_sums``), never a
single-partition window.  The fit is one aggregate over distinct CYCLE
weighted by the failure count, so failure rows are never joined back
unless the per-row table is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators import prefix
from kestrel.operators.skew import hot_key_join
from kestrel.session import ensure_shipped, keep

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results)
# event labels: failure, survivor
FAILURE = "故障"
SURVIVOR = "生存"
# reason code → event; unlisted reasons give the empty string
REASON_TO_EVENT = {"トラブル": FAILURE, "PM交換": SURVIVOR, "OTHER": SURVIVOR}
# y = ln(H) levels of the reported lives
B1_Y = -5.0
B10_Y = -2.250367327
B50_Y = -0.366512921
# points with ln(H) at or below this are not fitted; fitted line drawn from it to LINE_END_Y
MIN_LOG_H = -7.0
LINE_END_Y = 1.0
# two-slope fit bounds: slopes a, d and intercept b
SLOPE_BOUNDS = (0.1, 5.0)
INTERCEPT_BOUNDS = (-50.0, 50.0)
# ---------------------------------------------------------------------------


def classify_event(df: DataFrame, reason: str | Column = "REASON_KEY", out: str = "EVENT",
                   mapping: dict[str, str] | None = None) -> DataFrame:
    """Recode a reason column into the event label; unlisted → ''."""
    mapping = REASON_TO_EVENT if mapping is None else mapping
    rc = F.col(reason) if isinstance(reason, str) else reason
    expr = None
    for k, v in mapping.items():
        expr = (F.when(rc == k, F.lit(v)) if expr is None else expr.when(rc == k, F.lit(v)))
    expr = F.lit("") if expr is None else expr.otherwise(F.lit(""))
    return df.withColumn(out, expr)


def hazard_table(df: DataFrame, cycle: str = "CYCLE", event: str = "EVENT",
                 failure: str = FAILURE, keys_per_bucket: int = prefix.DEFAULT_KEYS_PER_BUCKET,
                 by: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """One row per distinct ``cycle`` (NULL and NaN dropped):

    * ``n`` rows, ``d`` failures at that value,
    * ``risk`` = average descending rank = N_greater + (n+1)/2 (ties get
      the mean of their ranks, as a descending average rank does),
    * ``hazard`` = d / risk (sum of the per-failure hazards 1/risk),
    * ``H`` = running sum of ``hazard`` over values ≤ cycle, so equal
      cycles share one total.

    ``by`` computes separate risk sets and running sums per group (e.g.
    product); the default pools every row, as the reference does.

    Runs small jobs (count, bucket split points, bucket totals) and
    persists the grouped table; the result itself is lazy.
    """
    by = list(by)
    g = (df.where(prefix.known(df, cycle))
         .groupBy(*by, cycle)
         .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
              F.sum(F.when(F.col(event) == failure, 1).otherwise(0)).cast("bigint").alias("d")))
    g = keep(g)
    splits = prefix.bucket_splits(g, cycle, keys_per_bucket)
    s1 = prefix.running_sums(g, cycle, {"_cum_n": "n"}, splits=splits, with_totals=True, keep_bucket=True,
                             group=by)
    s1 = s1.select(
        *by, prefix.BUCKET, cycle, "n", "d",
        ((F.col("_cum_n_total") - F.col("_cum_n")).cast("double")
         + (F.col("n").cast("double") + F.lit(1.0)) / F.lit(2.0)).alias("risk"))
    s1 = s1.withColumn("hazard", F.col("d").cast("double") / F.col("risk"))
    s1 = keep(s1)
    return prefix.running_sums(s1, cycle, {"H": "hazard"}, bucketed=True, group=by)


def hazard_rows(df: DataFrame, haz: DataFrame, cycle: str = "CYCLE", event: str = "EVENT",
                failure: str = FAILURE, by: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Per input row (NULL and NaN cycles removed): ``risk`` (average descending
    rank), and for failure rows ``hazard`` = 1/risk, ``H``, ``F`` =
    1-exp(-H), ``log_CYCLE``, ``log_H``.  Survivor rows keep NULL there."""
    is_f = F.col(event) == failure
    keyed = haz.select(*by, cycle, "n", "risk", "H")
    j = hot_key_join(df.where(prefix.known(df, cycle)), keyed.withColumnRenamed("n", "_n"), [*by, cycle], "_n")
    return (j.withColumn("hazard", F.when(is_f, F.lit(1.0) / F.col("risk")))
            .withColumn("H", F.when(is_f, F.col("H")))
            .withColumn("F", F.lit(1.0) - F.exp(-F.col("H")))
            .withColumn("log_CYCLE", F.when(F.col(cycle) > 0, F.ln(cycle)))
            .withColumn("log_H", F.when(F.col("H") > 0, F.ln("H"))))


def weibull_points(rows: DataFrame, event: str = "EVENT", failure: str = FAILURE,
                   min_log_h: float = MIN_LOG_H) -> DataFrame:
    """Failure rows whose ln(H) is above ``min_log_h`` (the fitted points)."""
    return rows.where((F.col(event) == failure) & (F.col("log_H") > min_log_h)
                      & F.col("log_CYCLE").isNotNull())


def _fit_points(haz: DataFrame, cycle: str, min_log_h: float, by=()) -> DataFrame:
    """Distinct (x=ln cycle, y=ln H, w=failures) rows that enter the fit."""
    return (haz.where((F.col("d") > 0) & (F.col(cycle) > 0) & (F.col("H") > 0))
            .select(*by, F.ln(cycle).alias("x"), F.ln("H").alias("y"), F.col("d").cast("double").alias("w"))
            .where(F.col("y") > min_log_h))


def _line_from_sums(n, sx, sy, sxx, sxy):
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    return slope, (sy - slope * sx) / n


def weibull_fit(haz: DataFrame, cycle: str = "CYCLE", min_log_h: float = MIN_LOG_H,
                by: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Least-squares line of ln H on ln t over failure points (one row, or
    one per ``by`` group): ``n, m, intercept, r, eta, b1, b10, b50``.
    Equal cycles are one weighted row, which gives the same sums as one
    row per failure."""
    by = list(by)
    p = _fit_points(haz, cycle, min_log_h, by)
    s = p.groupBy(*by).agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("x")).alias("sx"),
              F.sum(F.col("w") * F.col("y")).alias("sy"),
              F.sum(F.col("w") * F.col("x") * F.col("x")).alias("sxx"),
              F.sum(F.col("w") * F.col("x") * F.col("y")).alias("sxy"),
              F.sum(F.col("w") * F.col("y") * F.col("y")).alias("syy"))
    n, sx, sy, sxx, sxy, syy = (F.col(c) for c in ("n", "sx", "sy", "sxx", "sxy", "syy"))
    vx = n * sxx - sx * sx
    vy = n * syy - sy * sy
    m = (n * sxy - sx * sy) / vx
    b = (sy - m * sx) / n
    return s.select(
        *by, n.cast("bigint").alias("n"), m.alias("m"), b.alias("intercept"),
        ((n * sxy - sx * sy) / F.sqrt(vx * vy)).alias("r"),
        F.exp(-b / m).alias("eta"),
        F.exp((F.lit(B1_Y) - b) / m).alias("b1"),
        F.exp((F.lit(B10_Y) - b) / m).alias("b10"),
        F.exp((F.lit(B50_Y) - b) / m).alias("b50"))


def weibull_fit_line(fit: DataFrame, y_from: float = MIN_LOG_H, y_to: float = LINE_END_Y) -> DataFrame:
    """End points of the fitted line: rows (x = t, y = ln H) at y_from, y_to."""
    pts = F.array(*[F.struct(F.exp((F.lit(y) - F.col("intercept")) / F.col("m")).alias("x"),
                             F.lit(float(y)).alias("y")) for y in (y_from, y_to)])
    return fit.select(F.inline(pts))


# ---------------------------------------------------------------------------
# two-slope (segmented) fit


def _solve_box_ls(A: np.ndarray, r: np.ndarray, syy: np.ndarray,
                  lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimise p'Ap - 2r'p + syy over the box lo ≤ p ≤ hi for a batch of
    3×3 systems (A: k×3×3, r: k×3).  The problem is a convex QP, so its
    optimum is one of the KKT points: enumerate every free / at-lower /
    at-upper pattern, solve the free part, keep feasible ones, take the
    least objective.  Returns (params k×3, sse k)."""
    k = A.shape[0]
    best_p = np.full((k, 3), np.nan)
    best_s = np.full(k, np.inf)
    for pat in np.ndindex(3, 3, 3):  # 0 free, 1 lower, 2 upper
        fixed = np.array([s != 0 for s in pat])
        p = np.zeros((k, 3))
        for i, s in enumerate(pat):
            if s == 1:
                p[:, i] = lo[i]
            elif s == 2:
                p[:, i] = hi[i]
        free = np.where(~fixed)[0]
        if len(free):
            Aff = A[:, free][:, :, free]
            rhs = r[:, free] - np.einsum("kij,kj->ki", A[:, free][:, :, fixed], p[:, fixed])
            sol = np.einsum("kij,kj->ki", np.linalg.pinv(Aff), rhs)
            p[:, free] = sol
        ok = np.all((p >= lo - 1e-12) & (p <= hi + 1e-12), axis=1) & np.all(np.isfinite(p), axis=1)
        sse = syy - 2 * np.einsum("ki,ki->k", r, p) + np.einsum("ki,kij,kj->k", p, A, p)
        better = ok & (sse < best_s)
        best_p[better] = p[better]
        best_s[better] = sse[better]
    return best_p, best_s


def _box_at(c: np.ndarray, left: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parameters (b, a, d) and squared error of the best bounded line with its
    change point at each ``c``; ``left`` and ``total``: sums (w, x, xx, y, xy, yy)
    of the points up to c and of all."""
    nL, sxL, sxxL, syL, sxyL, _ = left.T
    nR, sxR, sxxR, syR, sxyR, _ = (total - left).T
    n, _, _, sy, _, syy = total.T
    su, sv = sxL + c * nR, sxR - c * nR
    suu, suv, svv = sxxL + c * c * nR, c * sv, sxxR - 2 * c * sxR + c * c * nR
    A = np.stack([np.stack([n, su, sv], -1), np.stack([su, suu, suv], -1), np.stack([sv, suv, svv], -1)], 1)
    r = np.stack([sy, sxyL + c * syR, sxyR - c * syR], -1)
    return _solve_box_ls(A, r, syy, _LOW, _HIGH)


_LOW = np.array([INTERCEPT_BOUNDS[0], SLOPE_BOUNDS[0], SLOPE_BOUNDS[0]])
_HIGH = np.array([INTERCEPT_BOUNDS[1], SLOPE_BOUNDS[1], SLOPE_BOUNDS[1]])


def _free_line(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slope, squared error) of each row of sums, no bounds (one x: slope 0)."""
    n, sx, sxx, sy, sxy, syy = sums.T
    n = np.maximum(n, 1e-300)
    vx, vy, vxy = sxx - sx * sx / n, syy - sy * sy / n, sxy - sx * sy / n
    some = vx > 1e-12 * np.maximum(sxx, 1e-300)
    slope = np.where(some, vxy / np.where(some, vx, 1), 0)
    return slope, np.maximum(vy - slope * vxy, 0)


def _left_line(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(intercept, slope) of the bounded line through each row of sums."""
    n, sx, sxx, sy, sxy, _ = sums.T
    A = np.stack([np.stack([n, sx], -1), np.stack([sx, sxx], -1)], 1)
    A3 = np.zeros((len(n), 3, 3))
    A3[:, :2, :2], A3[:, 2, 2] = A, 1.0
    p, _ = _solve_box_ls(A3, np.stack([sy, sxy, np.full(len(n), _LOW[2])], -1), np.zeros(len(n)), _LOW, _HIGH)
    return p[:, 0], p[:, 1]


def _joined_lines(c: np.ndarray, left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Squared error of the best line with its change point at each ``c`` and
    bounded slopes, the intercept free: inside the bounds, or on one of their
    four edges."""
    nL, sxL, sxxL, syL, sxyL, _ = left.T
    nR, sxR, sxxR, syR, sxyR, _ = (total - left).T
    n, _, _, sy, _, syy = total.T
    su, sv = sxL + c * nR, sxR - c * nR
    uu, vv = sxxL + c * c * nR - su * su / n, sxxR - 2 * c * sxR + c * c * nR - sv * sv / n
    uv, uy, vy = c * sv - su * sv / n, sxyL + c * syR - su * sy / n, sxyR - c * syR - sv * sy / n
    det = uu * vv - uv * uv
    some = det > 1e-12 * np.abs(uu * vv)
    lo, hi = _LOW[1:], _HIGH[1:]
    gain = lambda a, d: 2 * (a * uy + d * vy) - (a * a * uu + 2 * a * d * uv + d * d * vv)
    a, d = (uy * vv - vy * uv) / np.where(some, det, 1), (vy * uu - uy * uv) / np.where(some, det, 1)
    best = np.where(some & (a >= lo[0]) & (a <= hi[0]) & (d >= lo[1]) & (d <= hi[1]), gain(a, d), -np.inf)
    for at in (0, 1):
        a, d = (lo[0], hi[0])[at], (lo[1], hi[1])[at]
        best = np.maximum(best, gain(a, np.clip((vy - a * uv) / np.where(vv > 0, vv, np.inf), lo[1], hi[1])))
        best = np.maximum(best, gain(np.clip((uy - d * uv) / np.where(uu > 0, uu, np.inf), lo[0], hi[0]), d))
    return syy - sy * sy / n - best


def _bounded_line(sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(intercept, slope within the ``k``-th bounds, squared error), the intercept free."""
    n, sx, sxx, sy, sxy, syy = sums.T
    m = np.clip(_free_line(sums)[0], _LOW[k], _HIGH[k])
    n = np.maximum(n, 1e-300)
    error = syy - sy * sy / n - 2 * m * (sxy - sx * sy / n) + m * m * (sxx - sx * sx / n)
    return (sy - m * sx) / n, m, np.maximum(error, 0)


def change_bounds(lo: np.ndarray, hi: np.ndarray, left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What the squared error of each row is at least, its change point
    anywhere from ``lo`` to ``hi``: with bounded slopes and a free intercept the
    best is at an end, or where the two lines meet."""
    (i, a, ea), (j, d, ed) = _bounded_line(left, 1), _bounded_line(total - left, 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        meet = (j - i) / (a - d)
        room = 1e-6 * (1 + np.abs(meet))
        apart = (meet < lo - room) | (meet > hi + room)  # not so where undefined
    ends = np.minimum(_joined_lines(lo, left, total), _joined_lines(hi, left, total))
    return np.where(apart, ends, np.minimum(ends, ea + ed))


def best_change(x: np.ndarray, nxt: np.ndarray, left: np.ndarray, total: np.ndarray, c_lo: float, c_hi: float,
                chunk: int = 16, least: float = np.inf) -> tuple[float, np.ndarray, float, int] | None:
    """(c, (b, a, d), squared error, row) of the best change point between
    ``x`` and ``nxt`` of each row; None if all are worse than ``least``.  Fits
    with a free intercept bound a row's error from below (``change_bounds``), so
    rows come in that order until none can be better.  Within a row the best c
    is an end, or where the bounded line of the left points meets the line of
    the right ones."""
    lo, hi = np.maximum(x, c_lo), np.minimum(nxt, c_hi)
    rows = np.flatnonzero(lo <= hi)
    if not len(rows):
        return None
    bound = change_bounds(lo[rows], hi[rows], left[rows], total[rows])
    slack = 1e-9 * total[rows[0], 5]  # rounding of the sums
    order = np.argsort(bound, kind="stable")
    best = None
    for a in range(0, len(order), chunk):
        if bound[order[a]] > min(least, np.inf if best is None else best[2]) * (1 + 1e-12) + slack + 1e-15:
            break
        at = rows[order[a:a + chunk]]
        right = total[at] - left[at]
        b, slope = _left_line(left[at])
        d = np.clip(_free_line(right)[0], _LOW[2], _HIGH[2])
        meet = (right[:, 3] - d * right[:, 1]) / np.maximum(right[:, 0], 1e-300) - b
        with np.errstate(divide="ignore", invalid="ignore"):
            meet = meet / (slope - d)
        meet = np.clip(np.where(np.isfinite(meet), meet, lo[at]), lo[at], hi[at])
        for c in (lo[at], hi[at], meet):
            p, sse = _box_at(c, left[at], total[at])
            i = int(np.argmin(sse))
            if np.isfinite(sse[i]) and (best is None or (sse[i], c[i]) < (best[2], best[0])):
                best = (float(c[i]), p[i], float(sse[i]), int(at[i]))
    return best


SEGMENTED_SCHEMA = T.StructType([T.StructField(n, T.DoubleType()) for n in (
    "c", "a", "b", "d", "sse", "sse_line", "m1", "intercept1", "eta1", "m2", "intercept2", "eta2",
    "m", "intercept", "eta", "b10", "b50")])


LEAST_KEPT = 10_000  # groups whose best error so far a task remembers
_SUMS = ("_w", "_sx", "_sxx", "_sy", "_sxy", "_syy")


def weibull_segmented_fit(spark: SparkSession, haz: DataFrame, fit: DataFrame, cycle: str = "CYCLE", min_log_h: float = MIN_LOG_H,
                          by: tuple[str, ...] | list[str] = (), keys_per_bucket: int = prefix.DEFAULT_KEYS_PER_BUCKET) -> DataFrame:
    """Continuous two-slope line y = b + a·min(x,c) + d·max(x-c,0) on the
    fitted points, a, d ∈ SLOPE_BOUNDS, b ∈ INTERCEPT_BOUNDS, c between
    (B1_Y-b0)/m0 and 10·ln(b50) of the plain fit (capped to the data).

    For fixed c the model is linear, and running sums of the points' moments
    give those left and right of every c.  So the exact best change point
    between each two neighbouring points follows from their row alone
    (``best_change``); each task keeps its best row per group, and the least
    of these is the answer: one pass, no grid.  One row (SEGMENTED_SCHEMA)
    for each row of ``fit`` (one per ``by`` group); NULLs when the plain slope
    is outside the slope bounds (no admissible start) or there are no points.
    """
    by = list(by)
    pts = keep(_fit_points(haz, cycle, min_log_h, by).groupBy(*by, "x").agg(
        F.sum("w").alias("w"), (F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("y"), F.sum(F.col("w") * F.col("y") * F.col("y")).alias("wyy")))
    w, x, y = F.col("w"), F.col("x"), F.col("y")
    sums = dict(zip(_SUMS, (w.cast("double"), w * x, w * x * x, w * y, w * x * y, F.col("wyy"))))
    run = prefix.running_sums(pts.select(*by, "x", *[v.alias(f"{k}0") for k, v in sums.items()]), "x", {k: f"{k}0" for k in _SUMS},
                              with_totals=True, group=by, keys_per_bucket=keys_per_bucket, keep_bucket=True)
    run = run.drop(*[f"{k}0" for k in _SUMS])
    # the next x: within the bucket, else the first of the group's next bucket
    one = [F.lit(1)] if not by else []
    firsts = run.groupBy(*by, prefix.BUCKET).agg(F.min("x").alias("_first"))
    after = Window.partitionBy(*one, *by).orderBy(prefix.BUCKET)
    firsts = firsts.select(*by, prefix.BUCKET, F.lead("_first").over(after).alias("_next"))
    inside = Window.partitionBy(*by, prefix.BUCKET).orderBy("x")
    run = run.join(firsts, [*by, prefix.BUCKET]).withColumn("_next", F.coalesce(F.lead("x").over(inside), "_next", "x"))
    ends = pts.groupBy(*by).agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"), F.count(F.lit(1)).alias("_points"))
    if not by:  # one row each, as constants from here on
        whole, span = fit.first(), ends.first()
        fit = pts.sparkSession.createDataFrame([] if whole is None else [whole], fit.schema)
    c_lo = F.greatest((F.lit(B1_Y) - F.col("intercept")) / F.col("m"), F.col("_lo"))
    c_hi = F.least(F.when(F.col("b50") > 0, 10.0 * F.ln("b50")).otherwise(F.col("_hi")), F.col("_hi"))
    admitted = fit.where(F.col("m").between(*SLOPE_BOUNDS))
    limits = admitted.join(ends, by) if by else admitted.select("*", *[F.lit(span[c]).cast("double").alias(c) for c in ("_lo", "_hi")])
    limits = limits.select(*by, c_lo.alias("_c_lo"), F.greatest(c_hi, c_lo).alias("_c_hi"), *(["_points"] if by else []))
    if by:  # a row a group; a group with many points keeps its tasks
        run = hot_key_join(run, keep(limits), by, "_points")
    else:
        only = limits.first()
        if only is None:
            return fit.select(*[F.lit(None).cast("double").alias(k.name) for k in SEGMENTED_SCHEMA])
        run = run.withColumns({c: F.lit(only[c]).cast("double") for c in ("_c_lo", "_c_hi")})
    key = F.to_json(F.struct(*by)) if by else F.lit("")
    numbers = ["x", "_next", *_SUMS, *[f"{k}_total" for k in _SUMS], "_c_lo", "_c_hi"]
    run = run.select(*by, key.alias("_key"), *numbers)
    names = ["c", "b", "a", "d", "sse"]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[str, float] = {}  # of earlier batches
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)  # noqa: B023,E731
            keys = batch.column(len(by)).dictionary_encode()
            code, found, at = keys.indices.to_numpy(zero_copy_only=False), [], []
            left, total = (np.stack([get(f"{k}{end}") for k in _SUMS], 1) for end in ("", "_total"))
            x, nxt, lo, hi = (get(c) for c in ("x", "_next", "_c_lo", "_c_hi"))
            order = np.argsort(code, kind="stable")
            for mine in np.split(order, np.flatnonzero(np.diff(code[order])) + 1) if len(order) else []:
                name = keys.dictionary[code[mine[0]]].as_py()
                best = best_change(x[mine], nxt[mine], left[mine], total[mine], lo[mine[0]], hi[mine[0]], least=least.get(name, np.inf))
                if best is not None:
                    c, (b, a, d), sse, row = best
                    found.append((c, b, a, d, sse))
                    at.append(mine[row])
                    if len(least) < LEAST_KEPT:
                        least[name] = min(sse, least.get(name, np.inf))
            kept = batch.select([*by, *[f"{k}_total" for k in _SUMS]]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array([f[i] for f in found], pa.float64()) for i in range(5)]],
                                             names=[*kept.schema.names, *names])

    ensure_shipped(spark)
    schema = T.StructType([*[run.schema[c] for c in by], *[run.schema[f"{k}_total"] for k in _SUMS], *[T.StructField(n, T.DoubleType()) for n in names]])
    totals = [f"{k}_total" for k in _SUMS]
    best = run.mapInArrow(local, schema).groupBy(*by).agg(F.min(F.struct("sse", "c", "b", "a", "d", *totals)).alias("_best"))
    # without groups: best is one row, the plain fit constants beside it
    out = fit.join(best, by, "left") if by else best.select("*", *[F.lit(whole[c]).cast("double").alias(c) for c in ("m", "intercept", "eta", "b10", "b50")])
    f = lambda n: F.col(f"_best.{n}")
    n, sx, sxx, sy, sxy, syy = (f(t) for t in totals)
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    icept = (sy - slope * sx) / n
    line = syy - 2 * (icept * sy + slope * sxy) + icept * icept * n + 2 * icept * slope * sx + slope * slope * sxx
    a, b, c, d = f("a"), f("b"), f("c"), f("d")
    i2 = (a - d) * c + b
    columns = {"c": c, "a": a, "b": b, "d": d, "sse": f("sse"), "sse_line": line, "m1": a, "intercept1": b, "eta1": F.exp(-b / a),
               "m2": d, "intercept2": i2, "eta2": F.exp(-i2 / d), **{k: F.col(k) for k in ("m", "intercept", "eta", "b10", "b50")}}
    there = F.col("_best").isNotNull()
    return out.select(*by, *[F.when(there, columns[k.name].cast("double")).alias(k.name) for k in SEGMENTED_SCHEMA])


def weibull_parameter_table(seg: DataFrame) -> DataFrame:
    """Three rows (whole, below c, above c): m, eta, b10, b50 and the
    change-point label ``t<…`` / ``t>…`` (c shown as exp(c), rounded half
    to even to one decimal).  b10/b50 of the two-slope fit sit on the part
    whose line reaches that level on its own side of c; the other is NULL.
    ``seg`` is the one-row result of ``weibull_segmented_fit`` (it carries
    the plain fit too), so this is a projection."""
    j = seg
    c = F.col("c")

    def life(level: float):
        x1 = (F.lit(level) - F.col("intercept1")) / F.col("m1")
        x2 = (F.lit(level) - F.col("intercept2")) / F.col("m2")
        below = x1 < c
        return (F.when(below, F.exp(x1)), F.when(~below, F.exp(x2)))

    b10_1, b10_2 = life(B10_Y)
    b50_1, b50_2 = life(B50_Y)
    lab = F.bround(F.exp(c), 1).cast("string")
    def row(part, m, eta, b10, b50, label):
        return F.struct(F.lit(part).alias("part"), m.alias("m"), eta.alias("eta"), b10.alias("b10"),
                        b50.alias("b50"), label.alias("point_c"))

    rows = F.array(
        row(0, F.col("m"), F.col("eta"), F.col("b10"), F.col("b50"), F.lit("")),
        row(1, F.col("m1"), F.col("eta1"), b10_1, b50_1, F.concat(F.lit("t<"), lab)),
        row(2, F.col("m2"), F.col("eta2"), b10_2, b50_2, F.concat(F.lit("t>"), lab)))
    return j.select(F.inline(rows))


def weibull_polyline(seg: DataFrame, y_from: float = MIN_LOG_H, y_to: float = LINE_END_Y) -> DataFrame:
    """Fitted two-slope line as 2 or 3 (x = t, y) points: only the upper
    line when c lies before its start, only the lower line when c lies
    past its end, else start, change point and end."""
    m1, i1, m2, i2, c = (F.col(n) for n in ("m1", "intercept1", "m2", "intercept2", "c"))
    x_at = lambda y, m, i: F.exp((F.lit(y) - i) / m)
    before = (c < (F.lit(y_from) - i1) / m1) | (c < (F.lit(y_from) - i2) / m2)
    after = ((F.lit(y_to) - i1) / m1 < c) | ((F.lit(y_to) - i2) / m2 < c)
    pt = lambda x, y, k: F.struct(F.lit(k).alias("k"), x.alias("x"), y.alias("y"))
    two_upper = F.array(pt(x_at(y_from, m2, i2), F.lit(y_from), 0), pt(x_at(y_to, m2, i2), F.lit(y_to), 1))
    two_lower = F.array(pt(x_at(y_from, m1, i1), F.lit(y_from), 0), pt(x_at(y_to, m1, i1), F.lit(y_to), 1))
    three = F.array(pt(x_at(y_from, m1, i1), F.lit(y_from), 0), pt(F.exp(c), c * m1 + i1, 1),
                    pt(x_at(y_to, m2, i2), F.lit(y_to), 2))
    return seg.where(c.isNotNull()).select(
        F.inline(F.when(before, two_upper).when(after, two_lower).otherwise(three)))


def exact_median(df: DataFrame, col: str, keys_per_bucket: int = prefix.DEFAULT_KEYS_PER_BUCKET) -> DataFrame:
    """Exact median of a numeric column (NULLs skipped) without gathering
    the values in one task: count per distinct value, bucketed running
    count, pick the value(s) at the middle rank(s).  One row: ``median``."""
    g = (df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
         .groupBy(col).agg(F.count(F.lit(1)).alias("_n")))
    g = keep(g)
    s = prefix.running_sums(g, col, {"_cum": "_n"}, keys_per_bucket=keys_per_bucket, with_totals=True)
    r1 = F.floor((F.col("_cum_total") + 1) / 2)
    r2 = F.floor(F.col("_cum_total") / 2) + 1
    hit1 = (F.col("_cum") - F.col("_n") < r1) & (r1 <= F.col("_cum"))
    hit2 = (F.col("_cum") - F.col("_n") < r2) & (r2 <= F.col("_cum"))
    v = F.col(col).cast("double")
    return s.where(hit1 | hit2).agg(
        ((F.max(F.when(hit1, v)) + F.max(F.when(hit2, v))) / 2).alias("median"))


def mean_median(df: DataFrame, col: str = "CYCLE",
                keys_per_bucket: int = prefix.DEFAULT_KEYS_PER_BUCKET) -> DataFrame:
    """Mean, exact median and count of ``col`` (NULL/NaN skipped), one
    row, from one grouped table: per-value counts give the totals and the
    middle ranks."""
    g = (df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
         .groupBy(col).agg(F.count(F.lit(1)).alias("_n")))
    g = keep(g)
    v = F.col(col).cast("double")
    s = prefix.running_sums(g, col, {"_cum": "_n", "_sv": v * F.col("_n")},
                            keys_per_bucket=keys_per_bucket, with_totals=True)
    r1 = F.floor((F.col("_cum_total") + 1) / 2)
    r2 = F.floor(F.col("_cum_total") / 2) + 1
    hit1 = (F.col("_cum") - F.col("_n") < r1) & (r1 <= F.col("_cum"))
    hit2 = (F.col("_cum") - F.col("_n") < r2) & (r2 <= F.col("_cum"))
    return s.where(hit1 | hit2).agg(
        (F.first("_sv_total") / F.first("_cum_total")).alias("mean"),
        ((F.max(F.when(hit1, v)) + F.max(F.when(hit2, v))) / 2).alias("median"),
        F.first("_cum_total").cast("bigint").alias("n"))
