"""The digest that tells apart texts of rows with the same or no doc_id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_digest(text: str = "text") -> Column:
    """CRC-32 and MD5 as 20 bytes, so digests sort by CRC-32 first; null texts count as empty."""
    full = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return F.unhex(F.concat(F.lpad(F.hex(F.crc32(full)), 8, "0"), F.md5(full)))
