"""Validation of required fields, the quarantine and the validation report."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake import schema


def validity(required: Sequence[str] = schema.REQUIRED_COLUMNS) -> Column:
    """True when every required field is non-null (never null itself)."""
    return functools.reduce(operator.and_, [F.col(c).isNotNull() for c in required])


def validate_schema(
    df: DataFrame, required: Sequence[str] = schema.REQUIRED_COLUMNS
) -> DataFrame:
    """Rows whose required fields are all present. Empty strings pass."""
    return df.filter(validity(required))


def quarantined_orders(
    df: DataFrame, required: Sequence[str] = schema.REQUIRED_COLUMNS
) -> DataFrame:
    """The complement of :func:`validate_schema`, with the reasons per row."""
    return df.filter(~validity(required)).withColumn(schema.REASONS_COLUMN, quarantine_reasons(required))


def quarantine_reasons(required: Sequence[str] = schema.REQUIRED_COLUMNS) -> Column:
    """Which required fields are missing; an empty array for valid rows."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in required]))


def validation_report(
    df: DataFrame, required: Sequence[str] = schema.REQUIRED_COLUMNS
) -> DataFrame:
    """One row: total, valid and invalid counts plus nulls per required field."""
    valid = validity(required)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(~valid).alias("invalid_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required],
    )
