"""Delimited text scans, including cp932 (Shift_JIS family) files.

Spark's CSV reader rejects cp932 unless a session-wide legacy flag is
set, so the file is read as ISO-8859-1 (one byte → one char, splittable)
and string columns are re-decoded as cp932 in an Arrow-batched UDF.
Quoting uses '"' as escape so the cp932 second byte 0x5C ('\\') is never
taken as an escape character.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed layout: the 20 columns of the staging table, in file order
STAGING_SCHEMA = T.StructType([
    T.StructField("INDEX", T.LongType()),
    T.StructField("SERIAL", T.StringType()),
    T.StructField("PARTS_CD", T.StringType()),
    T.StructField("PARTS_NAME", T.StringType()),
    T.StructField("PARTS_TRADEPRICE", T.LongType()),
    T.StructField("OBSERVDAY", T.StringType()),
    T.StructField("REPORT_HEADER_ID", T.StringType()),
    T.StructField("REPORT_DETAIL_ID", T.StringType()),
    T.StructField("PRODUCT", T.StringType()),
    T.StructField("NUMBER_OF_ITEMS", T.LongType()),
    T.StructField("REASON_BODY", T.StringType()),
    T.StructField("UMSM", T.StringType()),
    T.StructField("METER_TOTAL", T.LongType()),
    T.StructField("REASON_KEY", T.StringType()),
    T.StructField("OBSERVDAY_DT", T.StringType()),
    T.StructField("METER_TOTAL_DIFF", T.DoubleType()),
    T.StructField("CYCLE", T.DoubleType()),
    T.StructField("COLOR", T.StringType()),
    T.StructField("OBSERVDAY_DATE", T.StringType()),
    T.StructField("OBSERVDAY_DT_TZ", T.StringType())])

NATIVE = {"utf-8", "utf8", "utf-16", "utf-16le", "utf-16be", "utf-32", "iso-8859-1", "latin1", "us-ascii"}


def redecode(encoding: str):
    @F.pandas_udf(T.StringType())
    def _dec(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else v.encode("latin-1").decode(encoding))
    return _dec


def delimited_scan(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   sep: str = "\t", header: bool = True, encoding: str = "cp932",
                   timestamp_format: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Header + delimited rows with a declared schema (no inference pass).
    A malformed row (wrong number of fields, unreadable value) fails the
    query; ``mode`` takes Spark's other choices."""
    native = encoding.lower() in NATIVE
    r = (spark.read.option("sep", sep).option("header", header).option("escape", '"').option("enforceSchema", False)
         .option("encoding", encoding if native else "iso-8859-1").option("mode", mode))
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    if native:
        return df
    dec = redecode(encoding)
    if header and schema is None:
        # names came through latin-1 as well
        df = df.toDF(*[c.encode("latin-1").decode(encoding) for c in df.columns])
    return df.select(*[dec(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])
