"""Date arithmetic with an explicit reference date (repeatable runs)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def antiquity_years(created: Column, as_of: str | dt.date) -> Column:
    """Fractional years between ``created`` and ``as_of`` (days / 365).

    No leap-year rule, may be negative; unparseable dates give null.
    """
    return F.datediff(F.lit(str(as_of)).cast("date"), created.try_cast("date")) / F.lit(365)
