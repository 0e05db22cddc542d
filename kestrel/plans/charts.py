"""Chart-table plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import charts as ch
from kestrel.operators import reliability as rel
from kestrel.plans.registry import plan
from kestrel.plans.reliability import _FIT, _G, _H, _R, weibull_input
from kestrel.sources.tables import table


@plan("scatter_series", ops=(96, 23), sql=f"""with {_G}, {_R}, {_H}
select l.l_linestatus as PRODUCT, round(ln(h.c), 9) as log_CYCLE, round(ln(h.H), 9) as log_H
from lineitem l join h on h.c = l.l_extendedprice
where l.l_returnflag = 'R' and h.c > 0 and h.H > 0 and ln(h.H) > -7 and l.l_linestatus in ('F', 'O')""")
def q_scatter_series(spark, sf):
    df = weibull_input(spark, sf)
    pts = rel.weibull_points(rel.hazard_rows(df, rel.hazard_table(df)))
    s = ch.scatter_series(pts, "PRODUCT", "log_CYCLE", "log_H", ["F", "O"])
    return s.select("PRODUCT", F.round("log_CYCLE", 9).alias("log_CYCLE"), F.round("log_H", 9).alias("log_H"))


@plan("fit_line_series", ops=(97, 70), sql=f"""{_FIT}
select 'fit' as series, round((-7 - b) / m, 9) as log_x, cast(-7 as double) as y from f
union all select 'fit', round((1 - b) / m, 9), cast(1 as double) from f""")
def q_fit_line_series(spark, sf):
    f = rel.weibull_fit(rel.hazard_table(weibull_input(spark, sf)))
    s = ch.fit_line_series(rel.weibull_fit_line(f), "fit")
    return s.select("series", F.round("log_x", 9).alias("log_x"), "y")


@plan("log_axis_filter", ops=(98,), sql="""
select event_id, value from events where event_id > 0 and value > 0 and value between 5 and 20""")
def q_log_axis_filter(spark, sf):
    return ch.log_axis_filter(table(spark, sf, "events").select("event_id", "value"), "event_id", "value")
