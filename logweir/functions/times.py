"""Event times are naive local times: TIMESTAMP_NTZ, so no session zone shifts them."""

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

from logweir.constants import LOG_ZONE


def seconds_sql(ts: str) -> str:
    """SQL text of `yyyy-MM-dd HH:mm:ss` without the fraction."""
    return f"substring_index(CAST(CAST({ts} AS TIMESTAMP_NTZ) AS STRING), '.', 1)"


def sink_time(ts: str, offset: str) -> Column:
    """ISO time with the configured UTC offset."""
    return F.expr(f"concat(replace({seconds_sql(ts)}, ' ', 'T'), '{offset}')")


def now_local(zone: str = LOG_ZONE) -> Column:
    """The time of the query in the zone that the logs are written in."""
    return F.expr(f"convert_timezone('{zone}', localtimestamp())")


def clock(zone: str = LOG_ZONE) -> datetime:
    """The driver's time in that zone, to the second."""
    return datetime.now(ZoneInfo(zone)).replace(tzinfo=None, microsecond=0)
