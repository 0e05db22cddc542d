"""Number / date formatting for reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: str | Column, digits: int = 1) -> Column:
    """Round half to even (Spark ``round`` is half-up)."""
    return F.bround(_c(c), digits)


def scientific_text(c: str | Column, decimals: int = 2) -> Column:
    """'1.23E+06': mantissa and exponent of two digits at least, ties to even."""
    x = _c(c).cast("double")
    guess = F.floor(F.log10(F.abs(x)))
    # the logarithm may be off by one next to a power of ten
    low = F.abs(x) / F.pow(F.lit(10.0), guess)
    e = guess + F.when(low >= 10, 1).when(low < 1, -1).otherwise(0)
    m = F.bround(x / F.pow(F.lit(10.0), e), decimals)
    over = F.abs(m) >= 10  # 9.999 rounds up to the next power
    m, e = F.when(over, m / 10).otherwise(m), e + F.when(over, 1).otherwise(0)
    zero = "0" + ("." + "0" * decimals if decimals else "") + "E+00"
    return F.when(x == 0, zero).when(x.isNotNull(), F.format_string(f"%.{decimals}fE%s%02d", m, F.when(e < 0, "-").otherwise("+"), F.abs(e)))


def number_report_text(c: str | Column, decimals: int = 0) -> Column:
    """'1,234,568 (1.23E+06)' style: grouped fixed point plus scientific,
    ties to even."""
    x = _c(c)
    return F.concat(F.format_string(f"%,.{decimals}f (", F.bround(x, decimals)), scientific_text(x), F.lit(")"))


def date_to_text(c: str | Column, fmt: str = "yyyy/MM/dd") -> Column:
    return F.date_format(_c(c), fmt)


def text_to_date(c: str | Column, formats=("yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "yyyy-MM-dd HH:mm:ss",
                                             "yyyy-MM-dd")) -> Column:
    """Parse text with the first format that fits (NULL when none does)."""
    return F.coalesce(*[F.try_to_timestamp(_c(c), F.lit(f)) for f in formats])


# Fixed report cell formats: integer '#,##0', float '#,##0.000',
# timestamp 'yyyy/mm/dd hh:mm:ss', text as is.
INT_DIGITS = 0
FLOAT_DIGITS = 3
TS_FORMAT = "yyyy/MM/dd HH:mm:ss"


def typed_report(df: DataFrame) -> DataFrame:
    """Every column rendered as report text by its type; unsupported
    types fail before anything runs (``assert_types``)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            e = F.format_number(c, INT_DIGITS)
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            e = F.format_number(c.cast("double"), FLOAT_DIGITS)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            e = F.date_format(c, TS_FORMAT)
        elif isinstance(t, T.StringType):
            e = c
        else:
            raise TypeError(f"unsupported column type {t.simpleString()} for {f.name}")
        out.append(e.alias(f.name))
    return df.select(*out)
