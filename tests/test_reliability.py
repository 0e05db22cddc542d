import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kestrel.operators import prefix
from kestrel.operators import reliability as rel
from kestrel.operators import windows

FIX = [(10.0, rel.FAILURE), (20.0, rel.FAILURE), (20.0, rel.SURVIVOR), (30.0, ""), (40.0, rel.FAILURE),
       (None, rel.FAILURE)]


def test_classify_event_default_branch(spark):
    df = spark.createDataFrame([("トラブル",), ("PM交換",), ("OTHER",), ("failure_maintenance",), (None,)], "REASON_KEY string")
    got = [r.EVENT for r in rel.classify_event(df).collect()]
    assert got == [rel.FAILURE, rel.SURVIVOR, rel.SURVIVOR, "", ""]


def test_hand_checked_fixture(spark):
    df = spark.createDataFrame(FIX, "CYCLE double, EVENT string")
    rows = rel.hazard_rows(df, rel.hazard_table(df)).orderBy("CYCLE", "EVENT").collect()
    assert [r.risk for r in rows] == [5.0, 3.5, 3.5, 2.0, 1.0]
    h = {(r.CYCLE, r.EVENT): r.H for r in rows}
    assert h[(10.0, rel.FAILURE)] == pytest.approx(0.2)
    assert h[(20.0, rel.FAILURE)] == pytest.approx(0.2 + 1 / 3.5)
    assert h[(40.0, rel.FAILURE)] == pytest.approx(1.2 + 1 / 3.5)
    assert h[(20.0, rel.SURVIVOR)] is None and h[(30.0, "")] is None


def _random(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    c = rng.integers(1, 400, n).astype(float)  # many ties
    e = np.where(rng.random(n) < 0.4, rel.FAILURE, rel.SURVIVOR)
    return spark.createDataFrame(pd.DataFrame({"CYCLE": c, "EVENT": e})), c, e


def test_prefix_equals_theta_self_join_definition(spark):
    """H via bucketed prefix sums == the literal O(n²) self-join."""
    df, c, e = _random(spark)
    haz = rel.hazard_table(df, keys_per_bucket=37)  # many buckets
    rows = rel.hazard_rows(df.withColumn("rid", F.monotonically_increasing_id()), haz)
    f = rows.where(F.col("EVENT") == rel.FAILURE).select("rid", "CYCLE", "hazard", "H")
    a, b = f.alias("a"), f.alias("b")
    theta = (a.join(b, F.col("b.CYCLE") <= F.col("a.CYCLE")).groupBy("a.rid")
             .agg(F.sum("b.hazard").alias("H2"), F.first("a.H").alias("H")))
    for r in theta.collect():
        assert r.H == pytest.approx(r.H2, rel=1e-12)


@pytest.mark.parametrize("kpb", [10_000_000, 100, 31])
def test_running_sum_partition_invariance(spark, kpb):
    rng = np.random.default_rng(3)
    keys = np.unique(rng.normal(size=2000))
    vals = rng.random(len(keys))
    df = spark.createDataFrame(pd.DataFrame({"k": keys, "v": vals})).repartition(13)
    out = prefix.running_sums(df, "k", {"cum": "v"}, keys_per_bucket=kpb, with_totals=True).orderBy("k").toPandas()
    assert np.allclose(out["cum"].to_numpy(), np.cumsum(vals))
    assert np.allclose(out["cum_total"].to_numpy(), vals.sum())


def test_bucket_splits_many_buckets(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("k"))
    s = prefix.bucket_splits(df, "k", keys_per_bucket=1000)
    assert 8 <= len(s) <= 9 and s == sorted(s)


def test_rank_average_desc_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,), (None,)], "x double")
    got = sorted((r.x, r.rank) for r in windows.rank_average_desc(df, "x").collect())
    assert got == [(1.0, 4.0), (2.0, 2.5), (2.0, 2.5), (3.0, 1.0)]


def test_cumulative_sum_ties_shares_total(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 3.0), (3, 4.0)], "k int, v double")
    got = {r.k: r.cum_sum for r in windows.cumulative_sum_ties(df, "k", "v", per_row=True).collect()}
    assert got == {1: 1.0, 2: 6.0, 3: 10.0}


@pytest.mark.parametrize("vals", [[5, 1, 3], [4, 1, 3, 2], [2, 2, 2, 9, 9, 1]])
def test_exact_median(spark, vals):
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    assert rel.exact_median(df, "x", keys_per_bucket=2).first()["median"] == pytest.approx(np.median(vals))


def test_weibull_fit_matches_numpy(spark):
    df, c, e = _random(spark, 4000, 7)
    haz = rel.hazard_table(df)
    fit = rel.weibull_fit(haz).first()
    rows = rel.weibull_points(rel.hazard_rows(df, haz)).select("log_CYCLE", "log_H").toPandas()
    m, b = np.polyfit(rows.log_CYCLE, rows.log_H, 1)
    assert fit.m == pytest.approx(m, rel=1e-9) and fit.intercept == pytest.approx(b, rel=1e-9)
    assert fit.eta == pytest.approx(math.exp(-b / m), rel=1e-9)
    assert fit.n == len(rows)


def _seg_points(spark, truth=(6.0, 1.0, 3.0, -4.0), n=3000, seed=5):
    c, a, d, b = truth
    rng = np.random.default_rng(seed)
    x = np.sort(rng.uniform(3, 9, n))
    y = b + a * np.minimum(x, c) + d * np.maximum(x - c, 0) + rng.normal(0, 0.05, n)
    # hazard-table shaped input: cycle = e^x, H = e^y, one failure each
    pdf = pd.DataFrame({"CYCLE": np.exp(x), "H": np.exp(y), "d": 1, "n": 1})
    return spark.createDataFrame(pdf), x, y


def test_segmented_fit_recovers_truth_and_beats_line(spark):
    haz, x, y = _seg_points(spark)
    fit = rel.weibull_fit(haz, min_log_h=-50)
    seg = rel.weibull_segmented_fit(spark, haz, fit, min_log_h=-50).first()
    assert seg.c == pytest.approx(6.0, abs=0.05)
    assert seg.a == pytest.approx(1.0, abs=0.02) and seg.d == pytest.approx(3.0, abs=0.02)
    assert seg.sse <= seg.sse_line
    # brute force over a dense grid of c: nothing clearly better exists
    best = np.inf
    for cc in np.linspace(x.min(), x.max(), 400):
        A = np.stack([np.ones_like(x), np.minimum(x, cc), np.maximum(x - cc, 0)], 1)
        sol, *_ = np.linalg.lstsq(A, y, rcond=None)
        best = min(best, float(((A @ sol - y) ** 2).sum()))
    assert seg.sse <= best + 1e-6


def test_change_point_is_exact_per_group(spark):
    """Not above a dense grid refined around its best value, in each group and
    over many buckets; bounds hold where they are active."""
    rng = np.random.default_rng(4)
    rows = []
    for p, (a, d, c) in {"steep": (0.5, 9.0, 5.0), "flat": (0.02, 2.0, 4.0), "kink": (3.0, 0.8, 5.5), "line": (1.3, 1.3, 5.0)}.items():
        x = np.sort(rng.uniform(2, 8, 300))
        y = -4 + a * np.minimum(x, c) + d * np.maximum(x - c, 0) + rng.normal(0, 0.3, 300)
        rows += [(p, float(np.exp(u)), 1, int(rng.integers(1, 4)), float(np.exp(v))) for u, v in zip(x, y)]
    haz = spark.createDataFrame(rows, "p string, CYCLE double, n long, d long, H double").repartition(5)
    fit = rel.weibull_fit(haz, min_log_h=-50, by=["p"]).withColumn("m", F.lit(1.5)).withColumn("b50", F.exp(F.lit(7.0) / 10))
    fit = fit.withColumn("intercept", F.lit(-5.0 - 1.5 * 2.5))  # change points between 2.5 and 7
    for kpb in (10_000_000, 40):
        got = {r.p: r for r in rel.weibull_segmented_fit(spark, haz, fit, min_log_h=-50, by=["p"], keys_per_bucket=kpb).collect()}
        assert len(got) == 4
        for p, r in got.items():
            x, y, w = np.array([(np.log(t), np.log(h), n) for q, t, _, n, h in rows if q == p]).T
            order = np.argsort(x)
            x, y, w = x[order], y[order], w[order]
            sums = np.stack([w, w * x, w * x * x, w * y, w * x * y, w * y * y], 1)
            total, lo, hi, best = sums.sum(0), max(2.5, x[0]), min(7.0, x[-1]), np.inf
            for _ in range(3):
                grid = np.linspace(lo, hi, 2000)
                left = np.concatenate([np.zeros((1, 6)), np.cumsum(sums, 0)])[np.searchsorted(x, grid, side="right")]
                _, sse = rel._box_at(grid, left, np.tile(total, (len(grid), 1)))
                i = int(sse.argmin())
                best = min(best, sse[i])
                lo, hi = grid[max(i - 1, 0)], grid[min(i + 1, len(grid) - 1)]
            assert r.sse <= best * (1 + 1e-9) and r.sse > best * (1 - 1e-4)
            model = r.b + r.a * np.minimum(x, r.c) + r.d * np.maximum(x - r.c, 0)
            assert (w * (y - model) ** 2).sum() == pytest.approx(r.sse, rel=1e-6)
            assert 0.1 <= r.a <= 5 and 0.1 <= r.d <= 5 and 2.5 <= r.c <= 7
        assert got["steep"].d == 5 and got["flat"].a == pytest.approx(0.1)


def test_change_point_without_admissible_slope(spark):
    haz = spark.createDataFrame([(float(k), 1, 1, float(k)) for k in range(1, 9)], "CYCLE double, n long, d long, H double")
    fit = rel.weibull_fit(haz, min_log_h=-50).withColumn("m", F.lit(7.0))
    assert rel.weibull_segmented_fit(spark, haz, fit, min_log_h=-50).first().c is None


def test_parameter_table_and_polyline(spark):
    haz, x, y = _seg_points(spark)
    fit = rel.weibull_fit(haz, min_log_h=-50)
    seg = rel.weibull_segmented_fit(spark, haz, fit, min_log_h=-50)
    t = rel.weibull_parameter_table(seg).orderBy("part").collect()
    assert [r.part for r in t] == [0, 1, 2]
    assert t[1].point_c.startswith("t<") and t[2].point_c.startswith("t>")
    assert (t[1].b10 is None) != (t[2].b10 is None)
    assert rel.weibull_polyline(seg).count() in (2, 3)


def test_hazard_by_group_equals_each_group_alone(spark):
    df, c, e = _random(spark, 3000, 11)
    df = df.withColumn("PRODUCT", (F.col("CYCLE") % 3).cast("int"))
    both = rel.hazard_table(df, keys_per_bucket=40, by=["PRODUCT"]).toPandas()
    for p in (0, 1, 2):
        alone = rel.hazard_table(df.where(F.col("PRODUCT") == p), keys_per_bucket=40).toPandas()
        got = both[both.PRODUCT == p].sort_values("CYCLE")
        alone = alone.sort_values("CYCLE")
        assert np.allclose(got.H.to_numpy(), alone.H.to_numpy())
        assert np.allclose(got.risk.to_numpy(), alone.risk.to_numpy())


def test_h_nondecreasing_and_f_in_unit_interval(spark):
    df, c, e = _random(spark, 2000, 13)
    rows = rel.hazard_rows(df, rel.hazard_table(df, keys_per_bucket=50)).where(F.col("H").isNotNull())
    p = rows.select("CYCLE", "H", "F").toPandas().sort_values("CYCLE")
    assert (np.diff(p.H.to_numpy()) >= -1e-12).all()
    assert ((p.F >= 0) & (p.F <= 1)).all()


def test_release_cached(spark):
    from kestrel.session import release_cached
    df, c, e = _random(spark, 500, 17)
    rel.hazard_table(df).count()
    assert release_cached() >= 2
    assert release_cached() == 0


def test_nan_cycles_are_not_at_risk(spark):
    df = spark.createDataFrame([(1.0, rel.FAILURE), (2.0, rel.FAILURE), (float("nan"), rel.SURVIVOR), (None, rel.SURVIVOR)], "CYCLE double, EVENT string")
    h = rel.hazard_table(df).orderBy("CYCLE").collect()
    assert [(r.CYCLE, r.risk, r.H) for r in h] == [(1.0, 2.0, 0.5), (2.0, 1.0, 1.5)]
    rows = rel.hazard_rows(df, rel.hazard_table(df))
    assert rows.count() == 2
    from kestrel.operators import windows
    assert windows.rank_average_desc(df, "CYCLE").count() == 2


def _weibull_like(n=20_000, seed=3):
    rng = np.random.default_rng(seed)
    x = np.sort(np.log(rng.uniform(900, 100_000, n)))
    y = np.log(np.cumsum(1 / (n - np.arange(n) + 0.5)))
    sums = np.cumsum(np.stack([np.ones(n), x, x * x, y, x * y, y * y], 1), 0)
    return x, np.append(x[1:], x[-1]), sums, np.tile(sums[-1], (n, 1))


def test_change_point_solves_few_rows(monkeypatch):
    """Bounds leave few of 20,000 rows to be solved, in a part far from the best
    one too, and the best of all is among them."""
    x, nxt, left, total = _weibull_like()
    solved, box = [], rel._box_at
    monkeypatch.setattr(rel, "_box_at", lambda c, le, t: solved.append(len(c)) or box(c, le, t))
    best = rel.best_change(x, nxt, left, total, x[0], x[-1])
    assert sum(solved) <= 3000
    solved.clear()
    for part in (slice(0, 2000), slice(18_000, 20_000)):
        rel.best_change(x[part], nxt[part], left[part], total[part], x[0], x[-1])
    assert sum(solved) <= 600
    bound = rel.change_bounds(x, nxt, left, total)
    for a in range(0, len(x), 4000):
        _, sse = box(x[a:a + 4000], left[a:a + 4000], total[a:a + 4000])
        assert (sse >= bound[a:a + 4000] - 1e-9 * total[0, 5]).all() and sse.min() >= best[2] * (1 - 1e-9)
    assert rel.best_change(x, nxt, left, total, x[0], x[-1], least=best[2] / 2) is None


def test_groups_with_many_points_keep_their_tasks(spark, monkeypatch):
    """Two groups are searched by more than two tasks."""
    from kestrel.operators import skew
    monkeypatch.setattr(skew.hot_key_join, "__defaults__", (500,))
    monkeypatch.setattr(rel.prefix, "MIN_KEYS_PER_BUCKET", 500)
    x, _, _, total = _weibull_like(4000)
    h = np.exp(np.log(np.cumsum(1 / (4000 - np.arange(4000) + 0.5))))
    haz = spark.createDataFrame([("ab"[i % 2], float(np.exp(a)), 1, 1, float(b)) for i, (a, b) in enumerate(zip(x, h))], "p string, CYCLE double, n long, d long, H double")
    seg = rel.weibull_segmented_fit(spark, haz, rel.weibull_fit(haz, by=["p"]), by=["p"])
    assert seg.where("c is not null").count() == 2
    assert "Union" in seg._jdf.queryExecution().toString()
