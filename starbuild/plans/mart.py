"""Staging tables to the star schema."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import date_parts, label_nulls
from ..operators.dims import CALENDAR, date_dim, dimension, grown_dimension
from ..operators.lookup import Lookup, left_enrich, lookup, lookup_losses_of, marked_lookups, missed_names
from ..operators.numbering import rank_in_group
from ..operators.pivot import PivotSpec, pivot_children
from ..operators.quality import duplicate_types, require_empty, spec_violations
from ..operators.skew import HOT_ROWS, hot_keys
from ..session import Counted
from ..sinks import overwrite
from .schemas import (
    GEOGRAPHY,
    GEOGRAPHY_ORDER,
    LABELLED,
    MEASURES,
    SPORT_TYPE,
    SPORT_TYPE_ORDER,
    ZONE_KEY,
    ZONE_SPEC,
)
from .staging import StagingTables

TIME_LOOKUP = {"start_year": "year", "start_month": "month", "start_day": "day"}


@dataclass(frozen=True)
class MartTables:
    sport_type: str = "dim_sport_type"
    geography: str = "dim_geography"
    time: str = "dim_time"
    activity: str = "ftr_activity"


def labelled(activity: DataFrame, fill_country: bool = False) -> DataFrame:
    """Activities with nulls labelled in their natural keys.

    The country is left out by default. An activity without one then finds no geography and drops out
    of the fact, although the dimension has a row for it; `fill_country` keeps it.
    """
    return label_nulls(activity, [*LABELLED, "location_country"] if fill_country else LABELLED)


def bucket_counts(zone: DataFrame, bucket: DataFrame) -> DataFrame:
    """The distinct (type, bucket_count) over all zones that have buckets."""
    per_zone = bucket.groupBy(*ZONE_KEY).agg(F.count("*").alias("_buckets"))
    zones = zone.groupBy(*ZONE_KEY, "type").agg(F.count("*").alias("_zones"))
    # Both sides are counted first, so the join meets each key once instead of once per bucket.
    return (
        zones.join(per_zone, ZONE_KEY)
        .select("type", (F.col("_zones") * F.col("_buckets")).alias("bucket_count"))
        .distinct()
    )


def zones_with_buckets(zone: DataFrame, bucket: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """Zones joined with their buckets, the buckets ranked by `min`; zones without any drop out.

    As a rule both tables are partitioned by activity once, which serves the ranking, this join,
    the pivot and the join with the activities. When an activity is too large for that, each step
    partitions by its own key. The rows are the same.
    """
    key, order = ["activity_id"], ["min", "max", "time"]
    if hot_keys(bucket.select(key).unionByName(zone.select(key)), key, min_rows):
        ranked = rank_in_group(bucket, ZONE_KEY, order)
    else:
        zone = zone.repartition(*key)
        ranked = rank_in_group(bucket.repartition(*key), ZONE_KEY, order, hot={})
    return zone.join(ranked, ZONE_KEY, "inner")


def zone_columns(
    zone: DataFrame, bucket: DataFrame, spec: PivotSpec = ZONE_SPEC, min_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per activity with the columns of `spec`."""
    return pivot_children(zones_with_buckets(zone, bucket, min_rows), "activity_id", spec)


def build_fact(
    activity: DataFrame,
    zone: DataFrame,
    bucket: DataFrame,
    sport_type: DataFrame,
    geography: DataFrame,
    time: DataFrame,
    spec: PivotSpec = ZONE_SPEC,
    rows: Mapping[str, int] | None = None,
) -> DataFrame:
    """The wide fact: one row per labelled activity that finds all three dimensions.

    The lookups come before the zone columns are joined on, so that rows that drop out do so
    early, and the wide columns pass no further join. `rows` may bring the sizes of the dimensions (sport_type, geography, time),
    as counted when they were written.
    """
    rows = rows or {}
    used = activity.select("id", *MEASURES, *SPORT_TYPE, *GEOGRAPHY, "start_date_local")
    found = lookup(date_parts(used, "start_date_local"), sport_type, SPORT_TYPE, ["sk_sport_type"], dim_rows=rows.get("sport_type"))
    found = lookup(found, geography, GEOGRAPHY, ["sk_geography"], dim_rows=rows.get("geography"))
    found = lookup(found, time, TIME_LOOKUP, ["sk_time"], dim_rows=rows.get("time"))
    fact = found.select(
        "id", *MEASURES, "start_hour", "start_minute", "start_second", "sk_sport_type", "sk_geography", "sk_time"
    )
    return left_enrich(fact, zone_columns(zone, bucket, spec), "id", "activity_id", hot=hot_keys(activity, ["id"]))


def build_mart(
    spark: SparkSession,
    staging: StagingTables = StagingTables(),
    mart: MartTables = MartTables(),
    spec: PivotSpec = ZONE_SPEC,
    calendar: tuple[str, str] = CALENDAR,
    fill_country: bool = False,
    root: str | None = None,
    keep_keys: bool = False,
    rejects: str | None = None,
) -> DataFrame:
    """Rebuild the three dimensions and the fact from the staging tables.

    They are one load: surrogate keys are numbered anew each time, unless `keep_keys`, which leaves those of stored dimensions
    as they are and numbers new natural keys behind them. The load stops before the fact
    if a zone type is null, has zones of different bucket counts, or does not fit `spec`. With `rejects`, a table of that
    name gets the activities that find no row in a dimension, with what they missed.
    """
    activity = labelled(spark.table(staging.activity), fill_country)
    zone, bucket = spark.table(staging.zone), spark.table(staging.bucket)
    counts: dict[str, Counted] = {}

    def stored(name: str, df: DataFrame, table: str) -> DataFrame:
        counts[name] = Counted()
        return overwrite(counts[name].watch(df), table, root=root)

    def numbered(key: str, columns: Mapping[str, str], order: list[str], table: str) -> DataFrame:
        if keep_keys and spark.catalog.tableExists(table):
            return grown_dimension(activity, spark.table(table), key, columns, order)
        return dimension(activity, key, columns, order)

    sport_type = stored("sport_type", numbered("sk_sport_type", SPORT_TYPE, SPORT_TYPE_ORDER, mart.sport_type), mart.sport_type)
    geography = stored("geography", numbered("sk_geography", GEOGRAPHY, GEOGRAPHY_ORDER, mart.geography), mart.geography)
    time = stored("time", date_dim(spark, *calendar), mart.time)
    require_empty(
        spec_violations(bucket_counts(zone, bucket), "type", "bucket_count", spec.types),
        "zone types do not fit the fact",
    )
    if not doubled_zones(zone).isEmpty():
        warnings.warn("activities have several zones of one type; the fact adds up their buckets", stacklevel=2)
    rows = {name: counted.rows for name, counted in counts.items()}
    if rejects is not None:
        overwrite(fact_rejects(activity, sport_type, geography, time, rows), rejects, root=root)
    fact = build_fact(activity, zone, bucket, sport_type, geography, time, spec, rows)
    return overwrite(fact, mart.activity, allow_schema_change=True, root=root)


def fact_lookups(
    sport_type: DataFrame, geography: DataFrame, time: DataFrame, rows: Mapping[str, int] | None = None
) -> list[Lookup]:
    """The lookups of the fact, in their order."""
    rows = rows or {}
    return [
        Lookup("sport_type", sport_type, SPORT_TYPE, rows=rows.get("sport_type")),
        Lookup("geography", geography, GEOGRAPHY, rows=rows.get("geography")),
        Lookup("time", time, TIME_LOOKUP, rows=rows.get("time")),
    ]


def _marked(activity: DataFrame, lookups: list[Lookup]) -> DataFrame:
    used = activity.select("id", *SPORT_TYPE, *GEOGRAPHY, "start_date_local")
    return marked_lookups(date_parts(used, "start_date_local"), lookups)


def fact_rejects(
    activity: DataFrame, sport_type: DataFrame, geography: DataFrame, time: DataFrame, rows: Mapping[str, int] | None = None
) -> DataFrame:
    """The labelled activities that the fact leaves out: id, their natural keys, missed (a bit for each lookup) and its names."""
    lookups = fact_lookups(sport_type, geography, time, rows)
    lost = _marked(activity, lookups).filter(F.col("missed") != 0)
    return lost.select(
        "id", *SPORT_TYPE, *GEOGRAPHY, "start_date_local", "missed", F.array_join(missed_names(lookups), ",").alias("dimensions")
    )


def lookup_losses(activity: DataFrame, sport_type: DataFrame, geography: DataFrame, time: DataFrame) -> DataFrame:
    """How many labelled activities each lookup drops by itself, in one pass over them."""
    lookups = fact_lookups(sport_type, geography, time)
    return lookup_losses_of(_marked(activity, lookups), lookups)


def doubled_zones(zone: DataFrame) -> DataFrame:
    """Activities with several zones of one type; the fact adds up their buckets."""
    return duplicate_types(zone, "activity_id", "type")
