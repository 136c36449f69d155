"""Column expressions of the trip cleaning step."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Rider spellings that count as each rider type.
RIDER_TYPES = {"member": ("member", "subscriber"), "casual": ("casual", "customer")}


def as_timestamp(column: str) -> Column:
    """Text to timestamp, NULL when it is not one."""
    return F.try_to_timestamp(F.col(column))


def as_double(column: str) -> Column:
    """Text to double, NULL when it is not a number."""
    return F.nanvl(F.col(column).try_cast("double"), F.lit(None).cast("double"))


def rider_type(column: str = "member_casual") -> Column:
    lowered = F.lower(column)
    known = F.when(lowered.isin(*RIDER_TYPES["member"]), "member")
    known = known.when(lowered.isin(*RIDER_TYPES["casual"]), "casual")
    return known.otherwise(lowered)


def duration_minutes(start: str = "started_at", end: str = "ended_at") -> Column:
    """Minutes between the whole seconds of both stamps."""
    return (F.unix_seconds(end) - F.unix_seconds(start)) / 60.0


def whole_seconds(minutes: str = "trip_duration_minutes") -> Column:
    """Exact seconds back from ``duration_minutes``, so that sums do not depend on row order."""
    return F.rint(F.col(minutes) * 60.0).cast("long")


def is_weekend_day(day_number: Column) -> Column:
    """Day numbers run from Sunday = 1 to Saturday = 7."""
    return day_number.isin(1, 7)


def calendar_columns(start: str = "started_at") -> dict[str, Column]:
    return {
        "start_date": F.to_date(start),
        "start_hour": F.hour(start),
        "day_of_week": F.date_format(start, "EEEE"),
        "day_of_week_num": F.dayofweek(start),
        "month": F.date_format(start, "yyyy-MM"),
        "is_weekend": is_weekend_day(F.dayofweek(start)),
    }


def ratio(total: Column, count: Column) -> Column:
    """Division that gives NULL, not an error, when nothing was counted."""
    return total / F.nullif(count, F.lit(0))
