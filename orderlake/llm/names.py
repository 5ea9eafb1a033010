"""Column names of operators that must not meet those of the caller's tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, with as many underscores behind it as keep it apart from the taken names."""
    used = {c.lower() for c in taken}  # Spark's names don't tell cases apart
    while name.lower() in used:
        name += "_"
    return name


def free_prefix(taken: Iterable[str], prefix: str) -> str:
    """``prefix``, with as many underscores behind it that none of the taken names begins with it."""
    used = [c.lower() for c in taken]
    while any(c.startswith(prefix.lower()) for c in used):
        prefix += "_"
    return prefix


def boxed(df: DataFrame, *plain: str | Column) -> DataFrame:
    """All columns of ``df`` in one struct, ``_row``, and the given ones beside it: other names are free then."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *plain)


def unboxed(df: DataFrame, columns: list[str], fresh: dict[str, Column] | None = None) -> DataFrame:
    """The columns that :func:`boxed` put away, some with new values."""
    return df.select(*[(fresh or {}).get(c, F.col("_row")[c]).alias(c) for c in columns])
