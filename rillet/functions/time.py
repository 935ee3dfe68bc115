"""Time helpers (X1-X5). All are session-time-zone independent: epoch
milliseconds are turned into wall-clock TIMESTAMP_NTZ values of an explicit
zone, then formatted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_millis(ntz) -> Column:
    """Wall-clock TIMESTAMP_NTZ (read as UTC) -> epoch milliseconds (bigint)."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), _c(ntz))


def millis_to_wall(ms, tz: str = "UTC") -> Column:
    """Epoch ms -> wall-clock TIMESTAMP_NTZ in zone ``tz``."""
    utc_wall = F.timestamp_add("MILLISECOND", _c(ms), F.expr(EPOCH_NTZ))
    if tz == "UTC":
        return utc_wall
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def day_of(ms, tz: str = "UTC") -> Column:
    """Epoch ms -> 'yyyy-MM-dd'."""
    return F.date_format(millis_to_wall(ms, tz), "yyyy-MM-dd")


def hour_of(ms, tz: str = "UTC") -> Column:
    """Epoch ms -> 'HH'."""
    return F.date_format(millis_to_wall(ms, tz), "HH")


def split_datetime(s) -> tuple[Column, Column]:
    """X3: 'yyyy-MM-dd HH:mm:ss' -> (date string, hour string); a part that is not there
    is null."""
    parts = F.split(_c(s), " ")
    return F.get(parts, F.lit(0)), F.get(F.split(F.get(parts, F.lit(1)), ":"), F.lit(0))


def age_years(birthday, as_of) -> Column:
    """Whole years between two dates (calendar rule, not months/12)."""
    b, n = _c(birthday), _c(as_of)
    return (F.year(n) - F.year(b)
            - F.when(F.date_format(n, "MMdd") < F.date_format(b, "MMdd"), 1).otherwise(0)).cast("int")


def previous_day(d) -> Column:
    """X5: 'yyyy-MM-dd' -> previous calendar day as 'yyyy-MM-dd'."""
    return F.date_format(F.date_sub(F.to_date(_c(d)), 1), "yyyy-MM-dd")
