"""Weibull plans on the driver tables.

Stand-in mapping: CYCLE = ``l_extendedprice``; EVENT from
``l_returnflag`` (R → failure, A and N → survivor); PRODUCT =
``l_linestatus``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import reliability as rel
from kestrel.operators import windows
from kestrel.plans.registry import plan
from kestrel.sources.tables import table

FLAG_TO_EVENT = {"R": rel.FAILURE, "A": rel.SURVIVOR, "N": rel.SURVIVOR}


def weibull_input(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("CYCLE"),
        F.col("l_returnflag").alias("REASON_KEY"), F.col("l_linestatus").alias("PRODUCT"))
    return rel.classify_event(li, "REASON_KEY", "EVENT", FLAG_TO_EVENT)


# SQL pieces shared by the oracle strings
_G = """g as (select l_extendedprice as c, count(*) as n,
                 sum(case when l_returnflag = 'R' then 1 else 0 end) as d
          from lineitem where l_extendedprice is not null group by 1)"""
_R = """r as (select c, n, d,
                 coalesce(sum(n) over (order by c desc rows between unbounded preceding and 1 preceding), 0)
                 + cast(n + 1 as double) / 2 as risk from g)"""
_H = """h as (select c, n, d, risk, d / risk as hazard,
                 sum(d / risk) over (order by c rows between unbounded preceding and current row) as H from r)"""
_FIT = f"""with {_G}, {_R}, {_H},
p as (select ln(c) as x, ln(H) as y from lineitem l join h on h.c = l.l_extendedprice
      where l.l_returnflag = 'R' and c > 0 and H > 0 and ln(H) > -7),
f as (select count(*) as n, regr_slope(y, x) as m, regr_intercept(y, x) as b, corr(y, x) as r from p)"""


@plan("weibull_fit", ops=(17, 20, 43, 44, 67, 68, 69), sql=f"""{_FIT}
select cast(n as bigint) as n, round(m, 6) as m, round(b, 6) as intercept, round(r, 6) as r,
       round(exp(-b / m), 3) as eta, round(exp((-5 - b) / m), 3) as b1,
       round(exp((-2.250367327 - b) / m), 3) as b10, round(exp((-0.366512921 - b) / m), 3) as b50 from f""")
def q_weibull_fit(spark, sf):
    haz = rel.hazard_table(weibull_input(spark, sf))
    f = rel.weibull_fit(haz)
    return f.select("n", *[F.round(c, 6).alias(c) for c in ("m", "intercept", "r")],
                    *[F.round(c, 3).alias(c) for c in ("eta", "b1", "b10", "b50")])


@plan("cumulative_hazard", ops=(67,), sql=f"""with {_G}, {_R}, {_H}
select c as CYCLE, cast(n as bigint) as n, cast(d as bigint) as d, risk,
       round(hazard, 9) as hazard, round(H, 9) as H from h""")
def q_cumulative_hazard(spark, sf):
    haz = rel.hazard_table(weibull_input(spark, sf))
    return haz.select("CYCLE", "n", "d", "risk", F.round("hazard", 9).alias("hazard"),
                      F.round("H", 9).alias("H"))


@plan("theta_self_join_sum", ops=(28, 35), sql=f"""with {_G}, {_R}, {_H}
select l.l_orderkey, l.l_linenumber, round(h.H, 9) as H
from lineitem l join h on h.c = l.l_extendedprice where l.l_returnflag = 'R'""")
def q_theta_self_join_sum(spark, sf):
    """Per failure row: the sum of hazards of failures with CYCLE ≤ its
    own (the reference's O(n²) self-join), as a prefix sum."""
    df = weibull_input(spark, sf)
    rows = rel.hazard_rows(df, rel.hazard_table(df))
    return rows.where(F.col("EVENT") == rel.FAILURE).select(
        "l_orderkey", "l_linenumber", F.round("H", 9).alias("H"))


@plan("weibull_points", ops=(68, 22, 21, 62), sql=f"""with {_G}, {_R}, {_H}
select l.l_orderkey, l.l_linenumber, h.c as CYCLE, round(1.0 / h.risk, 12) as hazard,
       round(h.H, 9) as H, round(1 - exp(-h.H), 9) as F,
       round(ln(h.c), 9) as log_CYCLE, round(ln(h.H), 9) as log_H
from lineitem l join h on h.c = l.l_extendedprice
where l.l_returnflag = 'R' and h.c > 0 and h.H > 0 and ln(h.H) > -7""")
def q_weibull_points(spark, sf):
    df = weibull_input(spark, sf)
    pts = rel.weibull_points(rel.hazard_rows(df, rel.hazard_table(df)))
    return pts.select("l_orderkey", "l_linenumber", "CYCLE",
                      F.round("hazard", 12).alias("hazard"),
                      *[F.round(c, 9).alias(c) for c in ("H", "F", "log_CYCLE", "log_H")])


@plan("rank_average_desc", ops=(43, 24), sql="""
select l_orderkey, l_linenumber, l_extendedprice as CYCLE,
       cast(rank() over (order by l_extendedprice desc) as double)
       + cast(count(*) over (partition by l_extendedprice) - 1 as double) / 2 as rank
from lineitem where l_extendedprice is not null""")
def q_rank_average_desc(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("CYCLE"))
    return windows.rank_average_desc(df, "CYCLE").select("l_orderkey", "l_linenumber", "CYCLE", "rank")


@plan("cumulative_sum_ties", ops=(44,), sql="""
select l_quantity, round(sum(sum(l_extendedprice)) over (order by l_quantity
       rows between unbounded preceding and current row), 4) as cum_price
from lineitem where l_quantity is not null group by l_quantity""")
def q_cumulative_sum_ties(spark, sf):
    li = table(spark, sf, "lineitem")
    s = windows.cumulative_sum_ties(li, "l_quantity", "l_extendedprice", "cum_price")
    return s.select("l_quantity", F.round("cum_price", 4).alias("cum_price"))


@plan("mean_median", ops=(34, 64), sql="""
select round(avg(l_extendedprice), 6) as mean, round(median(l_extendedprice), 6) as median,
       count(l_extendedprice) as n,
       printf('%,.0f (%.2E)', avg(l_extendedprice), avg(l_extendedprice)) as mean_text
from lineitem""")
def q_mean_median(spark, sf):
    from kestrel.functions.format import number_report_text
    li = table(spark, sf, "lineitem")
    mm = rel.mean_median(li, "l_extendedprice")
    return mm.select(F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "n",
                     number_report_text(F.col("mean"), 0).alias("mean_text"))


@plan("linear_regression", ops=(36,), sql="""
select count(*) as n, round(regr_slope(l_extendedprice, l_quantity), 6) as slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) as intercept,
       round(corr(l_extendedprice, l_quantity), 9) as r,
       round(sqrt((regr_syy(l_extendedprice, l_quantity) / regr_sxx(l_extendedprice, l_quantity)
             - pow(regr_slope(l_extendedprice, l_quantity), 2)) / (count(*) - 2)), 6) as std_err
from lineitem where l_quantity is not null and l_extendedprice is not null""")
def q_linear_regression(spark, sf):
    from kestrel.operators.aggregate import linear_regression
    li = table(spark, sf, "lineitem")
    r = linear_regression(li, "l_quantity", "l_extendedprice")
    return r.select("n", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"),
                    F.round("r", 9).alias("r"), F.round("std_err", 6).alias("std_err"))


@plan("weibull_fit_line", ops=(70,), sql=f"""{_FIT}
select round(exp((-7 - b) / m), 3) as x, cast(-7 as double) as y from f
union all select round(exp((1 - b) / m), 3) as x, cast(1 as double) as y from f""")
def q_weibull_fit_line(spark, sf):
    f = rel.weibull_fit(rel.hazard_table(weibull_input(spark, sf)))
    return rel.weibull_fit_line(f).select(F.round("x", 3).alias("x"), "y")


@plan("classify_event", ops=(17,), sql="""
select l_orderkey, l_linenumber,
       case when l_returnflag = 'R' then '故障' when l_returnflag = 'A' then '生存'
            when l_returnflag = 'N' then '生存' else '' end as EVENT
from lineitem""")
def q_classify_event(spark, sf):
    return weibull_input(spark, sf).select("l_orderkey", "l_linenumber", "EVENT")


@plan("filter_not_null", ops=(20,), sql="""
select l_orderkey, l_linenumber, l_extendedprice as CYCLE from lineitem where l_extendedprice is not null""")
def q_filter_not_null(spark, sf):
    from kestrel.operators.relational import filter_not_null
    return filter_not_null(weibull_input(spark, sf), "CYCLE").select(
        "l_orderkey", "l_linenumber", "CYCLE")


def _fit_and_seg(spark, sf):
    haz = rel.hazard_table(weibull_input(spark, sf))
    fit = rel.weibull_fit(haz)
    return fit, rel.weibull_segmented_fit(spark, haz, fit)


def _stage(k: int, lo: str, hi: str) -> str:
    """Least squares of the two-slope line for 401 values of c; the best one."""
    return f"""grid{k} as (select {lo} + ({hi} - {lo}) * i / 400 as c, ({hi} - {lo}) / 400 as step from lim, range(401) t(i)),
s{k} as (select c, any_value(step) as step, sum(w) as n, sum(w * least(x, c)) as su, sum(w * greatest(x - c, 0)) as sv, sum(w * y) as sy,
                sum(w * least(x, c) * least(x, c)) as suu, sum(w * greatest(x - c, 0) * greatest(x - c, 0)) as svv,
                sum(w * least(x, c) * greatest(x - c, 0)) as suv, sum(w * least(x, c) * y) as suy,
                sum(w * greatest(x - c, 0) * y) as svy, sum(w * y * y) as syy from wp, grid{k} group by c),
m{k} as (select *, suu - su * su / n as uu, svv - sv * sv / n as vv, suv - su * sv / n as uv, suy - su * sy / n as uy,
                svy - sv * sy / n as vy, syy - sy * sy / n as yy from s{k}),
q{k} as (select *, (uy * vv - vy * uv) / (uu * vv - uv * uv) as a, (vy * uu - uy * uv) / (uu * vv - uv * uv) as d from m{k} where uu * vv > uv * uv),
o{k} as (select c, step, a, d, (sy - a * su - d * sv) / n as b, yy - a * uy - d * vy as sse from q{k} order by sse limit 1)"""


#: The same fit by repeated grids in SQL (its slopes lie inside the bounds on these tables).
_SEG = f"""{_FIT},
wp as (select x, y, count(*) as w from p group by 1, 2),
lim as (select greatest((-5 - b) / m, (select min(x) from p)) as lo, least(10 * (-0.366512921 - b) / m, (select max(x) from p)) as hi from f),
{_stage(1, 'lo', 'hi')},
{_stage(2, '(select c - step from o1)', '(select c + step from o1)')},
{_stage(3, '(select c - step from o2)', '(select c + step from o2)')},
seg as (select o3.c, a, o3.b, d, sse, a as m1, o3.b as i1, d as m2, (a - d) * o3.c + o3.b as i2, f.m, f.b as intercept from o3, f)"""

_PARTS = """parts as (
  select 0 as part, m, -intercept / m as log_eta, (-2.250367327 - intercept) / m as log_b10, (-0.366512921 - intercept) / m as log_b50,
         '' as side, cast(null as double) as log_c from seg
  union all select 1, m1, -i1 / m1, case when (-2.250367327 - i1) / m1 < c then (-2.250367327 - i1) / m1 end,
         case when (-0.366512921 - i1) / m1 < c then (-0.366512921 - i1) / m1 end, 't<', c from seg
  union all select 2, m2, -i2 / m2, case when not (-2.250367327 - i1) / m1 < c then (-2.250367327 - i2) / m2 end,
         case when not (-0.366512921 - i1) / m1 < c then (-0.366512921 - i2) / m2 end, 't>', c from seg)
select cast(part as int) as part, round(m, 3) as m, round(log_eta, 3) as log_eta, round(log_b10, 3) as log_b10,
       round(log_b50, 3) as log_b50, side, round(log_c, 3) as log_c from parts"""


def _shown(t):
    """The parameter table with lives as logarithms, as far as two grid searches agree."""
    label = F.coalesce(F.col("point_c").cast("string"), F.lit(""))
    return t.select("part", F.round("m", 3).alias("m"), F.round(F.ln("eta"), 3).alias("log_eta"), F.round(F.ln("b10"), 3).alias("log_b10"),
                    F.round(F.ln("b50"), 3).alias("log_b50"), F.substring(label, 1, 2).alias("side"),
                    F.round(F.ln(F.expr("try_cast(substring(point_c, 3) as double)")), 3).alias("log_c"))


@plan("weibull_segmented_fit", ops=(71,), sql=f"""{_SEG}
select round(c, 3) as c, round(a, 3) as a, round(b, 2) as b, round(d, 3) as d, round(sse, 3) as sse, true as better from seg""")
def q_weibull_segmented_fit(spark, sf):
    _, seg = _fit_and_seg(spark, sf)
    return seg.select(F.round("c", 3).alias("c"), F.round("a", 3).alias("a"), F.round("b", 2).alias("b"), F.round("d", 3).alias("d"),
                      F.round("sse", 3).alias("sse"), (F.col("sse") < F.col("sse_line")).alias("better"))


@plan("weibull_parameter_table", ops=(72,), sql=f"{_SEG}, {_PARTS}")
def q_weibull_parameter_table(spark, sf):
    _, seg = _fit_and_seg(spark, sf)
    return _shown(rel.weibull_parameter_table(seg))


@plan("weibull_polyline", ops=(72, 97), sql=f"""{_SEG}
select cast(k as int) as k, round(log_x, 3) as log_x, round(y, 2) as y from (
  select 0 as k, (-7 - i1) / m1 as log_x, -7.0 as y from seg union all select 1, c, c * m1 + i1 from seg
  union all select 2, (1 - i2) / m2, 1.0 from seg)""")
def q_weibull_polyline(spark, sf):
    _, seg = _fit_and_seg(spark, sf)
    return rel.weibull_polyline(seg).select("k", F.round(F.ln("x"), 3).alias("log_x"), F.round("y", 2).alias("y"))


_G_BY = """g as (select l_linestatus as p, l_extendedprice as c, count(*) as n,
                 sum(case when l_returnflag = 'R' then 1 else 0 end) as d
          from lineitem where l_extendedprice is not null group by 1, 2)"""
_R_BY = """r as (select p, c, n, d,
                 coalesce(sum(n) over (partition by p order by c desc rows between unbounded preceding and 1 preceding), 0)
                 + cast(n + 1 as double) / 2 as risk from g)"""
_H_BY = """h as (select p, c, n, d, risk,
                 sum(d / risk) over (partition by p order by c rows between unbounded preceding and current row) as H from r)"""


@plan("weibull_fit_by_product", ops=(69, 67, 96), sql=f"""with {_G_BY}, {_R_BY}, {_H_BY},
pt as (select h.p, ln(h.c) as x, ln(h.H) as y from lineitem l join h on h.c = l.l_extendedprice and h.p = l.l_linestatus
       where l.l_returnflag = 'R' and h.c > 0 and h.H > 0 and ln(h.H) > -7),
f as (select p, count(*) as n, regr_slope(y, x) as m, regr_intercept(y, x) as b from pt group by p)
select p as PRODUCT, cast(n as bigint) as n, round(m, 6) as m, round(b, 6) as intercept,
       round(exp(-b / m), 3) as eta, round(exp((-2.250367327 - b) / m), 3) as b10 from f""")
def q_weibull_fit_by_product(spark, sf):
    """Separate risk sets and fits per PRODUCT (the reference pools them)."""
    haz = rel.hazard_table(weibull_input(spark, sf), by=["PRODUCT"])
    f = rel.weibull_fit(haz, by=["PRODUCT"])
    return f.select("PRODUCT", "n", F.round("m", 6).alias("m"), F.round("intercept", 6).alias("intercept"),
                    F.round("eta", 3).alias("eta"), F.round("b10", 3).alias("b10"))


def _stage_by(k: int, source: str, lo: str, hi: str) -> str:
    """As _stage, for every product of ``source``."""
    return f"""grid{k} as (select p, {lo} + ({hi} - {lo}) * i / 400 as c, ({hi} - {lo}) / 400 as step from {source}, range(401) t(i)),
s{k} as (select p, c, any_value(step) as step, sum(w) as n, sum(w * least(x, c)) as su, sum(w * greatest(x - c, 0)) as sv, sum(w * y) as sy,
                sum(w * least(x, c) * least(x, c)) as suu, sum(w * greatest(x - c, 0) * greatest(x - c, 0)) as svv,
                sum(w * least(x, c) * greatest(x - c, 0)) as suv, sum(w * least(x, c) * y) as suy,
                sum(w * greatest(x - c, 0) * y) as svy, sum(w * y * y) as syy from wp join grid{k} using (p) group by p, c),
m{k} as (select *, suu - su * su / n as uu, svv - sv * sv / n as vv, suv - su * sv / n as uv, suy - su * sy / n as uy,
                svy - sv * sy / n as vy, syy - sy * sy / n as yy from s{k}),
q{k} as (select *, (uy * vv - vy * uv) / (uu * vv - uv * uv) as a, (vy * uu - uy * uv) / (uu * vv - uv * uv) as d from m{k} where uu * vv > uv * uv),
o{k} as (select p, c, step, a, d, (sy - a * su - d * sv) / n as b, yy - a * uy - d * vy as sse from q{k}
         qualify row_number() over (partition by p order by yy - a * uy - d * vy) = 1)"""


@plan("weibull_segmented_by_product", ops=(71, 96), sql=f"""with {_G_BY}, {_R_BY}, {_H_BY},
pt as (select h.p, ln(h.c) as x, ln(h.H) as y from lineitem l join h on h.c = l.l_extendedprice and h.p = l.l_linestatus
       where l.l_returnflag = 'R' and h.c > 0 and h.H > 0 and ln(h.H) > -7),
f as (select p, regr_slope(y, x) as m, regr_intercept(y, x) as b, min(x) as x0, max(x) as x1 from pt group by p),
wp as (select p, x, y, count(*) as w from pt group by 1, 2, 3),
lim as (select p, greatest((-5 - b) / m, x0) as lo, least(10 * (-0.366512921 - b) / m, x1) as hi from f),
{_stage_by(1, 'lim', 'lo', 'hi')},
{_stage_by(2, 'o1', '(c - step)', '(c + step)')},
{_stage_by(3, 'o2', '(c - step)', '(c + step)')}
select p as PRODUCT, round(c, 3) as c, round(a, 3) as a, round(b, 2) as b, round(d, 3) as d, round(sse, 3) as sse, true as better from o3""")
def q_weibull_segmented_by_product(spark, sf):
    """The two-slope fit of every product on its own risk set."""
    haz = rel.hazard_table(weibull_input(spark, sf), by=["PRODUCT"])
    seg = rel.weibull_segmented_fit(spark, haz, rel.weibull_fit(haz, by=["PRODUCT"]), by=["PRODUCT"]).where("c is not null")
    return seg.select("PRODUCT", F.round("c", 3).alias("c"), F.round("a", 3).alias("a"), F.round("b", 2).alias("b"), F.round("d", 3).alias("d"),
                      F.round("sse", 3).alias("sse"), (F.col("sse") < F.col("sse_line")).alias("better"))


@plan("regression_p_value", ops=(36,), sql="""
with s as (select c_nationkey, count(*) as n, regr_slope(c_acctbal, c_custkey) as slope, regr_sxx(c_acctbal, c_custkey) as sxx, regr_syy(c_acctbal, c_custkey) as syy
           from customer where c_acctbal is not null group by c_nationkey),
e as (select *, sqrt((syy / sxx - slope * slope) / (n - 2)) as std_err, (n - 2)::double as v from s where n > 2),
t as (select *, abs(slope / std_err) as t, abs(slope / std_err) / 4000 as h from e)
select c_nationkey, n, round(slope, 9) as slope, round(std_err, 9) as std_err,
       round(1 - 2 * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi()) * h / 3 * list_sum(list_transform(range(4001),
         lambda i: (case when i = 0 or i = 4000 then 1 when i % 2 = 1 then 4 else 2 end) * pow(1 + (i * h) * (i * h) / v, -(v + 1) / 2))), 8) as p_value
from t""")
def q_regression_p_value(spark, sf):
    """The p-value of account balances' slope over customer numbers, in each
    nation (SQL integrates the t density; here it is a continued fraction)."""
    from kestrel.operators.aggregate import linear_regression
    r = linear_regression(table(spark, sf, "customer"), "c_custkey", "c_acctbal", ["c_nationkey"]).where("n > 2")
    return r.select("c_nationkey", "n", F.round("slope", 9).alias("slope"), F.round("std_err", 9).alias("std_err"), F.round("p_value", 8).alias("p_value"))
