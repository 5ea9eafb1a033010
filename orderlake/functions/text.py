"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_trim(col: str) -> Column:
    """Lower case, then strip spaces at both ends (tabs are kept)."""
    return F.trim(F.lower(F.col(col)))


def initcap_trim(col: str) -> Column:
    """Title case split on spaces only, rest lower case, then trimmed."""
    return F.trim(F.initcap(F.col(col)))
