"""Exact money arithmetic.

Doubles summed in shuffle order give results that change from run to run,
so money is held as decimals with two places and only turned into doubles
for reporting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def money(col: Column | str, dtype: str) -> Column:
    """Decimal value of ``col``; null where it does not fit (NaN, inf, huge)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(dtype)


def avg2(col: Column | str) -> Column:
    """Mean of the non-null values rounded half-up to two places.

    ``sum / count`` on decimals keeps 16 fractional digits before the final
    rounding, so the result equals the exactly rounded mean (``avg`` would
    round to 6 places first and can round twice).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.try_divide(F.sum(c), F.count(c)), 2)


def report_doubles(df: DataFrame) -> DataFrame:
    """Turn every decimal column into a double for display or comparison."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
