"""Semi and anti joins of wide rows by bit filters of fixed size.

The keys' hashes set bits of a map of ``2 ** log_bits`` bits, built by a
grouped ``bit_or`` and broadcast: its size is a parameter, not a matter of
the data.  A row whose bit is clear in the keys' filter surely has no
partner.  The rows' keys that pass it wrongly (found by a join of keys
alone) make a second filter; a row that passes the first and not the second
surely has a partner.  Only what is left, rows that pass both, is shuffled
for an exact join.  More keys than bits make the filters useless, never
wrong.  Null keys have no partner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_BITS = 22  # a map of 65,536 words of 64 bits


def _bit(on: list[str], log_bits: int) -> Column:
    return F.pmod(F.xxhash64(*on, F.lit(5)), F.lit(1 << log_bits))


def with_flag(df: DataFrame, keys: DataFrame, on: list[str], flag: str, log_bits: int = LOG_BITS) -> DataFrame:
    """``df`` with ``flag``: false only where no row of ``keys`` has its key."""
    word, mask = F.shiftright("__bit", 6), F.expr("shiftleft(1L, cast(__bit & 63 as int))")
    bits = (keys.select(_bit(on, log_bits).alias("__bit")).groupBy(word.alias("__word")).agg(F.bit_or(mask).alias("__mask")))
    found = (df.withColumn("__bit", _bit(on, log_bits)).withColumn("__word", word)
             .join(F.broadcast(bits), "__word", "left"))  # 2 ** (log_bits - 6) rows at most
    return found.withColumn(flag, F.coalesce(F.col("__mask").bitwiseAND(mask) != 0, F.lit(False))).drop("__bit", "__word", "__mask")


def _flagged(df: DataFrame, keys: DataFrame, on: list[str], log_bits: int) -> tuple[DataFrame, DataFrame]:
    """(``df`` with __first and __second, distinct keys)."""
    keys = keys.select(*on).dropna().distinct()
    first = with_flag(df, keys, on, "__first", log_bits)
    wrong = first.where("__first").select(*on).distinct().join(keys, on, "left_anti")
    return with_flag(first, wrong, on, "__second", log_bits), keys


def semi_join(df: DataFrame, keys: DataFrame, on: list[str], log_bits: int = LOG_BITS) -> DataFrame:
    """Rows of ``df`` with a partner in ``keys``."""
    flagged, keys = _flagged(df, keys, on, log_bits)
    unsure = flagged.where("__first and __second").join(keys, on, "left_semi")
    return flagged.where("__first and not __second").unionByName(unsure).select(*df.columns)


def anti_join(df: DataFrame, keys: DataFrame, on: list[str], log_bits: int = LOG_BITS) -> DataFrame:
    """Rows of ``df`` without a partner in ``keys``, for keys that few rows
    have: only rows that pass the first filter are shuffled."""
    keys = keys.select(*on).dropna().distinct()
    flagged = with_flag(df, keys, on, "__first", log_bits)
    unsure = flagged.where("__first").join(keys, on, "left_anti")
    return flagged.where("not __first").unionByName(unsure).select(*df.columns)
