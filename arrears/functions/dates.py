"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def previous_month(day: Column) -> Column:
    """``yyyy-MM`` of the month before ``day``."""
    return F.date_format(F.add_months(F.to_date(day), -1), "yyyy-MM")


def run_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmm")


def age_in_days(day: Column, reference: Column | str) -> Column:
    end = F.to_date(F.lit(reference)) if isinstance(reference, str) else F.to_date(reference)
    return F.datediff(end, F.to_date(day))
