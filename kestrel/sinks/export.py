"""Delimited export and table writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def double_text(c: Column) -> Column:
    """A double as the shortest text that reads back equal, written the
    common scripting way: plain from 1e-4 to below 1e16, else 1.5e+16,
    1e-05; nan and inf in lower case."""
    digits = c.cast("string")  # shortest digits, but with E from 1e7 on
    d = digits.cast("double")
    plain = ((F.abs(d) >= 1e-4) & (F.abs(d) < 1e16)) | (d == 0)
    fixed = F.when(F.contains(digits, F.lit("E")), F.regexp_replace(F.regexp_replace(
        d.cast("decimal(38,20)").cast("string"), r"0+$", ""), r"\.$", ".0")).otherwise(digits)
    mantissa = F.regexp_replace(F.substring_index(digits, "E", 1), r"\.0$", "")
    power = F.substring_index(digits, "E", -1).cast("int")
    size = F.abs(power).cast("string")
    scientific = F.concat(mantissa, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
                          F.when(F.abs(power) < 10, F.lpad(size, 2, "0")).otherwise(size))
    return (F.when(F.isnan(d), F.lit("nan")).when(d == float("inf"), F.lit("inf")).when(d == float("-inf"), F.lit("-inf"))
            .when(plain, fixed).otherwise(scientific))


def csv_lines(df: DataFrame, sep: str = ",", date_format: str = "yyyy-MM-dd",
              timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """One ``value`` line per row: numbers bare, every other value (and
    every NULL) in double quotes with inner quotes doubled, no header."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            parts.append(F.when(c.isNull(), F.lit('""')).otherwise(double_text(c)))
        elif isinstance(f.dataType, NUMERIC):
            parts.append(F.when(c.isNull(), F.lit('""')).otherwise(c.cast("string")))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            parts.append(_quoted(F.date_format(c, timestamp_format)))
        elif isinstance(f.dataType, T.DateType):
            parts.append(_quoted(F.date_format(c, date_format)))
        else:
            parts.append(_quoted(c.cast("string")))
    return df.select(F.concat_ws(sep, *parts).alias("value"))


def csv_export(df: DataFrame, out_dir: str, name: str | None = None, sep: str = ",") -> str:
    """Write the lines as text part files under ``<out_dir>/<name>.csv/``
    (one part per task; no single-writer bottleneck).  Returns the path."""
    path = f"{out_dir.rstrip('/')}/{name or 'export'}.csv"
    csv_lines(df, sep).write.mode("overwrite").option("lineSep", "\n").text(path)
    return path


def staging_overwrite(df: DataFrame, target: str, fmt: str = "parquet", jdbc_url: str | None = None,
                      jdbc_props: dict | None = None, batchsize: int = 10_000) -> None:
    """Replace the whole staging table with ``df``: a Parquet/table path,
    or over JDBC with TRUNCATE (keeps the table definition) and batched
    inserts.  JDBC overwrite is not atomic; write a shadow table and swap
    when readers must never see a partial load."""
    if jdbc_url:
        w = (df.write.format("jdbc").mode("overwrite").option("url", jdbc_url).option("dbtable", target)
             .option("truncate", "true").option("batchsize", batchsize))
        for k, v in (jdbc_props or {}).items():
            w = w.option(k, v)
        w.save()
    else:
        df.write.mode("overwrite").format(fmt).save(target)


def text_write(df: DataFrame, col: str, path: str, rows_per_file: int = 0) -> None:
    """Plain text, one line per row; with ``rows_per_file`` in files of at
    most so many rows (files that are read whole stay small)."""
    df.select(F.col(col).alias("value")).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).text(path)


def parameter_output(df: DataFrame, path: str) -> None:
    """A small result table as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
