"""Tables behind charts (the drawing itself is left to the client)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.relational import filter_in_list


def scatter_series(points: DataFrame, series: str, x: str, y: str, selected=None,
                   fractions: dict | None = None, seed: int = 0) -> DataFrame:
    """(series, x, y) rows for the selected series.  ``fractions`` (per
    series value) thins very large series with ``sampleBy`` before a
    client collects them; by default every point is kept."""
    p = points if selected is None else filter_in_list(points, series, selected)
    p = p.select(series, x, y)
    if fractions:
        p = p.sampleBy(series, fractions, seed)
    return p


def fit_line_series(line: DataFrame, name: str, x: str = "x", y: str = "y") -> DataFrame:
    """Fitted-line points with x on the log scale and a series name."""
    return line.select(F.lit(name).alias("series"), F.ln(x).alias("log_x"), F.col(y).alias("y"))


def log_axis_filter(df: DataFrame, x: str, y: str, y_lo: float = 5.0, y_hi: float = 20.0) -> DataFrame:
    """Points drawable on two log axes (x > 0, y > 0) inside the y window."""
    return df.where((F.col(x) > 0) & (F.col(y) > 0) & F.col(y).between(y_lo, y_hi))
