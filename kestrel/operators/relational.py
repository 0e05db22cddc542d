"""Projections, recodes, filters, checks and key joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results)
LEVEL_LOW = ("1", "2", "3")
LEVEL_HIGH = ("4", "5")
CORRECT_USE = ("1", "1.0", "T", "TRUE")
CORRECT_OMIT = ("0", "0.0", "F", "FALSE")
# ---------------------------------------------------------------------------


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def select_columns(df: DataFrame, cols, extra=()) -> DataFrame:
    """Keep a fixed column list (a missing column fails at analysis)."""
    return df.select(*cols, *extra)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def rename_upper(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def cast_string(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def fill_null(df: DataFrame, values: dict) -> DataFrame:
    return df.na.fill(values)


def nan_to_null(df: DataFrame, cols=None, integral: dict | None = None) -> DataFrame:
    """Float NaN → NULL in ``cols`` (default: all float/double columns).
    ``integral`` names columns to cast to bigint afterwards (a Spark
    column has one type, so a per-value check becomes a per-column choice);
    a value with a fraction fails the query instead of being cut."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    out = df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in cols})
    for c in (integral or {}):
        x = F.col(c)
        out = out.withColumn(c, F.when(x.isNull() | (x == F.floor(x)), x.cast("bigint")).otherwise(
            F.raise_error(F.concat(F.lit(f"{c} is not integral: "), x.cast("string"))).cast("bigint")))
    return out


def bucket_level(c: str | Column, low=LEVEL_LOW, high=LEVEL_HIGH) -> Column:
    """1,2,3 → LOW; 4,5 → HIGH; anything else unchanged (as text)."""
    s = _c(c).cast("string")
    return F.when(s.isin(*low), F.lit("LOW")).when(s.isin(*high), F.lit("HIGH")).otherwise(s)


def recode_correct(c: str | Column, use=CORRECT_USE, omit=CORRECT_OMIT) -> Column:
    """1/T/TRUE → USE; 0/F/FALSE → OMIT; else unchanged (as text)."""
    s = _c(c).cast("string")
    return F.when(s.isin(*use), F.lit("USE")).when(s.isin(*omit), F.lit("OMIT")).otherwise(s)


def filter_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def filter_range(df: DataFrame, col: str, lo=None, hi=None, lo_inclusive: bool = False,
                 hi_inclusive: bool = True) -> DataFrame:
    c = F.col(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((c >= lo) if lo_inclusive else (c > lo))
    if hi is not None:
        cond = cond & ((c <= hi) if hi_inclusive else (c < hi))
    return df.where(cond)


def filter_in_list(df: DataFrame, col: str, values) -> DataFrame:
    """Membership filter.  A DataFrame of values becomes a left-semi join
    (planned as broadcast when small, else shuffle); a list stays an IN."""
    if isinstance(values, DataFrame):
        v = values.select(F.col(values.columns[0]).alias(col)).distinct()
        return df.join(v, col, "left_semi")
    return df.where(F.col(col).isin(list(values)))


def assert_domain(df: DataFrame, col: str, expected) -> DataFrame:
    """Values of ``col`` outside the expected set and expected values that
    never occur (the offenders; empty when the domain is exactly right).
    Lazy; call ``check_domain`` to raise."""
    spark = df.sparkSession
    exp = spark.createDataFrame([(v,) for v in expected], T.StructType(
        [T.StructField("_expected", T.StringType())]))
    found = df.select(F.col(col).cast("string").alias("_found")).distinct()
    j = found.join(F.broadcast(exp), F.col("_found").eqNullSafe(F.col("_expected")), "full_outer")
    return j.where(F.col("_found").isNull() | F.col("_expected").isNull()).select(
        F.coalesce("_found", "_expected").alias("value"),
        F.when(F.col("_expected").isNull(), F.lit("unexpected")).otherwise(F.lit("missing")).alias("problem"))


def check_domain(df: DataFrame, col: str, expected) -> None:
    bad = assert_domain(df, col, expected).collect()  # distinct values of a class column
    if bad:
        raise AssertionError(f"{col}: domain mismatch {[(r.value, r.problem) for r in bad]}")


def assert_count(parts: DataFrame, split_col: str = "split", names=("train", "test")) -> DataFrame:
    """One row: all rows, rows that landed in one of the named parts, and
    whether they agree (one aggregate)."""
    return parts.agg(F.count(F.when(F.col(split_col).isin(*names), 1)).cast("bigint").alias("split_total"),
                     F.count(F.lit(1)).cast("bigint").alias("total")) \
        .withColumn("ok", F.col("split_total") == F.col("total"))


SUPPORTED_REPORT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                          T.DoubleType, T.DecimalType, T.StringType, T.TimestampType,
                          T.TimestampNTZType, T.DateType)


def assert_types(df: DataFrame, allowed=SUPPORTED_REPORT_TYPES) -> DataFrame:
    """Fail before running anything when a column type is unsupported."""
    for f in df.schema.fields:
        if not isinstance(f.dataType, allowed):
            raise TypeError(f"unsupported column type {f.dataType.simpleString()} for {f.name}")
    return df


def semi_join_split(df: DataFrame, ids: DataFrame, key: str = "ID") -> DataFrame:
    """Rows whose key is in ``ids`` (left semi join; Spark picks broadcast
    or shuffle by size)."""
    return df.join(ids.select(key), key, "left_semi")


def zip_columns(left: DataFrame, right: DataFrame, key: str = "ID") -> DataFrame:
    """Put columns of two tables side by side by key (positions do not
    exist in Spark)."""
    return left.join(right, key)
