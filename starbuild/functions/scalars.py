"""Column expressions of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_VALUE = "N/A"


def label_nulls(df: DataFrame, columns: Sequence[str], label: str = NO_VALUE) -> DataFrame:
    """Replace nulls in string columns by a label that joins can match."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(label)) for c in columns})


def to_local_time(text: Column) -> Column:
    """Wall-clock time of an ISO string, whatever the session's time zone.

    The source marks local times with a Z; the zone is dropped rather than applied.
    """
    return text.cast("timestamp_ntz")


def date_parts(df: DataFrame, column: str, prefix: str = "start_") -> DataFrame:
    """Add year, month, day, hour, minute and second of an ISO string or timestamp, as ints."""
    at = to_local_time(F.col(column))
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour, "minute": F.minute, "second": F.second}
    return df.withColumns({prefix + name: part(at) for name, part in parts.items()})


def date_key(day: Column) -> Column:
    """Date as text yyyyMMdd."""
    return F.date_format(day, "yyyyMMdd")


def zone_of(text: Column) -> Column:
    """The zone's name in text like "(GMT+01:00) Europe/Oslo"; text without the bracket is a name itself."""
    return F.regexp_replace(F.trim(text), r"^\([^)]*\)\s*", "")


def _offset(utc: Column, zone: Column) -> Column:
    """Seconds that clocks in `zone` are ahead at an instant (a wall-clock time of UTC)."""
    return F.timestamp_diff("SECOND", utc, F.convert_timezone(F.lit("UTC"), zone, utc))


def zone_time(df: DataFrame, local: str, zone: str) -> DataFrame:
    """Add what a local wall-clock time means in the zone of its row: utc, offset_seconds and clock.

    `local` is an ISO string or timestamp, taken as wall-clock time whatever zone it is marked with and whatever the session zone.
    clock is "gap" for a time that clocks skipped (utc counts on from before, so the clock shows it later), "overlap" for one that they showed
    twice (utc is the earlier), else "once". A null time or zone gives nulls; an unknown zone is an error.
    """
    at, name = F.col("_local"), F.col("_zone")
    before, after = (_offset(F.timestamp_add("DAY", F.lit(n), at), name) for n in (-1, 1))
    tried = df.withColumns({"_local": to_local_time(F.col(local)), "_zone": zone_of(F.col(zone))}).withColumns({"_before": before, "_after": after})
    first, second = (F.timestamp_add("SECOND", -F.col(c), at) for c in ("_before", "_after"))
    # an offset is right if it is the one in force at the instant that it leads to
    shown = tried.withColumns({"_first": _offset(first, name) == F.col("_before"), "_second": _offset(second, name) == F.col("_after")})
    taken = F.when(F.col("_first") | ~F.col("_second"), F.col("_before")).otherwise(F.col("_after"))
    kind = (
        F.when(~F.col("_first") & ~F.col("_second"), "gap")
        .when(F.col("_first") & F.col("_second") & (F.col("_before") != F.col("_after")), "overlap")
        .when(taken.isNotNull(), "once")
    )
    return shown.select(
        *df.columns,
        F.timestamp_add("SECOND", -taken, at).alias("utc"),
        # in a gap, the offset that the clock has at that instant
        F.when(kind == "gap", F.col("_after")).otherwise(taken).alias("offset_seconds"),
        kind.alias("clock"),
    )
