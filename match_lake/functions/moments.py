"""Points in time as parameters, never the clock."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(moment: datetime | str) -> Column:
    """Literal timestamp; a naive value is taken as UTC."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.lit(moment)


def hours_before(moment: datetime | str, hours: int) -> Column:
    return instant(moment) - F.make_dt_interval(F.lit(0), F.lit(hours))


def iso_utc(epoch_seconds: Column) -> Column:
    """Epoch seconds as an ISO-8601 text in UTC (needs a UTC session)."""
    return F.date_format(F.timestamp_seconds(epoch_seconds), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
