"""Column expressions built only from ``pyspark.sql.functions``."""

from orderlake.functions.money import avg2, money, report_doubles
from orderlake.functions.rules import (
    between_or_null,
    in_domain,
    positive_or_null,
    revenue_bucket,
    rfm_segment,
    run_id,
)
from orderlake.functions.text import initcap_trim, lower_trim

__all__ = [
    "avg2",
    "between_or_null",
    "in_domain",
    "initcap_trim",
    "lower_trim",
    "money",
    "positive_or_null",
    "report_doubles",
    "revenue_bucket",
    "rfm_segment",
    "run_id",
]
