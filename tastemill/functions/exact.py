"""Sums and rounding whose result does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1e9
#: Scaled terms are added as two integers: how many LIMBs, and the rest.
LIMB = 1 << 18
#: Largest scaled term, and the size from which a double has no fraction.
_LARGEST, _WHOLE = float(1 << 80), float(1 << 53)


def _failed(message: str) -> Column:
    return F.raise_error(F.lit(message)).cast("double")


def exact_sum(term: Column, scale: float = SCALE) -> Column:
    """Sum of doubles rounded at 1 / scale, the same bits for every partitioning.

    A term is added as two integers, so the sum of 3e13 rows stays exact while
    it is under 2.4e24 / scale. Beyond that, or with a term that is larger,
    infinite or NaN, it raises, in ANSI mode or not.
    """
    scaled = term * F.lit(scale) + F.lit(0.5)
    whole = F.when(F.abs(scaled) < F.lit(_WHOLE), F.floor(scaled).cast("double")).otherwise(scaled)
    fits = scaled.isNull() | (F.abs(scaled) < F.lit(_LARGEST))
    checked = F.when(fits, whole).otherwise(_failed("a term is out of the range of an exact sum"))
    high = F.floor(checked / F.lit(float(LIMB)))
    low = (checked - high.cast("double") * F.lit(float(LIMB))).cast("bigint")
    highs, lows = F.try_sum(high), F.try_sum(low)
    # Totals of ordinary size stay in BIGINT arithmetic; DECIMAL is for the others.
    small = (F.abs(highs) < F.lit(1 << 43)) & (lows < F.lit(1 << 61))
    wide = highs.cast("decimal(20,0)") * F.lit(LIMB).cast("decimal(7,0)") + lows.cast("decimal(20,0)")
    total = F.when(small, (highs * F.lit(LIMB) + lows).cast("double")).otherwise(wide.cast("double"))
    over = highs.isNull() & lows.isNotNull()
    return F.when(over, _failed("an exact sum is out of range")).otherwise(total) / F.lit(scale)


def round6(value: Column) -> Column:
    """Round half up at six places in plain double arithmetic (no BigDecimal).

    From 9e9 on a double has no sixth place worth rounding, and stays as it is.
    """
    return F.when(
        F.abs(value) < F.lit(9e9), F.floor(value * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)
    ).otherwise(value)


def hash_int(*parts: Column) -> Column:
    """First 32 bits of an md5 as BIGINT: a hash any engine can repeat."""
    text = F.concat_ws("-", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail early, with the operator's own words, when a model column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; got {df.columns}")
    return df
