"""Date parts and durations, all built-in expressions (stay inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from etoile.functions.numeric import round_half_even

SECONDS_PER_DAY = 86400.0


def delay_days(start: Column, end: Column, digits: int = 1) -> Column:
    """(end - start) in fractional days, rounded half to even; null if either side is null."""
    secs = F.timestamp_diff("SECOND", start, end)
    return round_half_even(secs / F.lit(SECONDS_PER_DAY), digits)


def date_parts(date_col: Column) -> dict[str, Column]:
    """Calendar attributes of the time dimension, keyed by output column name."""
    return {
        "date_str": F.date_format(date_col, "yyyy-MM-dd"),
        "jour": F.dayofmonth(date_col),
        "mois": F.month(date_col),
        "nom_mois": F.date_format(date_col, "MMMM"),
        "trimestre": F.quarter(date_col),
        "annee": F.year(date_col),
    }


def parse_timestamp(col: Column) -> Column:
    """Text to TIMESTAMP_NTZ, whatever the session's time zone; unparseable text becomes null."""
    return col.try_cast("timestamp_ntz")
