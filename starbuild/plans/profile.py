"""Counts that describe the zone and bucket tables; read-only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.quality import count_of_counts, group_size_hist, row_counts, top_rows
from ..operators.skew import skew_join
from .mart import doubled_zones
from .schemas import ZONE_KEY


def zone_buckets(zone: DataFrame, bucket: DataFrame) -> DataFrame:
    """Zones joined with their buckets by key."""
    return skew_join(bucket, zone, ZONE_KEY).select(*zone.columns, *[c for c in bucket.columns if c not in ZONE_KEY])


def profile(zone: DataFrame, bucket: DataFrame) -> dict[str, DataFrame]:
    """The reports by name, none of them run yet."""
    joined = zone_buckets(zone, bucket)
    ranges = count_of_counts(joined, [*ZONE_KEY, "type", "min", "max"], ["type", "min", "max"], "count")
    return {
        "row_counts": row_counts({"zone": zone, "bucket": bucket}),
        "zones_per_activity": group_size_hist(zone, ["activity_id"], name="count"),
        "buckets_per_zone": group_size_hist(bucket, ZONE_KEY, name="count"),
        "buckets_per_zone_by_type": group_size_hist(joined, [*ZONE_KEY, "type"], ["type"], "count"),
        "range_counts": ranges,
        "range_counts_top": top_rows(ranges.select("type", "min", "max", "count", "groups")),
        "doubled_zones": doubled_zones(zone),
    }


def profile_sets(zone: DataFrame, bucket: DataFrame) -> DataFrame:
    """The counts of counts of `profile` in one pass: report, type, min, max, count and groups.

    Each table is read once, as rows of one narrow frame. Rows are added up by zone and range, zones lend their type to their
    ranges, and the first row of each zone and of each activity stands for it. Report rows are counted by report, so the
    last shuffle carries partial counts of few keys and no task holds a key per range. Columns that a report does not tell apart are null in it.
    """
    zones = zone.select(*ZONE_KEY, "type", F.lit(None).cast("int").alias("min"), F.lit(None).cast("int").alias("max"), F.lit(1).alias("zones"), F.lit(0).alias("buckets"))
    buckets = bucket.select(*ZONE_KEY, F.lit(None).cast("string").alias("type"), "min", "max", F.lit(0).alias("zones"), F.lit(1).alias("buckets"))
    sums = [F.sum("zones").alias("zones"), F.sum("buckets").alias("buckets")]
    folded = zones.unionByName(buckets).groupBy(*ZONE_KEY, "min", "max").agg(F.max("type").alias("type"), *sums)
    # one shuffle by activity serves the windows of activities and of zones, whose partitioning it satisfies; each folded
    # row is a range, the first of a zone or of an activity stands for it, so no aggregate over many keys is left to run
    of_zone, of_activity = Window.partitionBy(*ZONE_KEY), Window.partitionBy("activity_id")
    typed = folded.repartition("activity_id").select(
        *ZONE_KEY, F.max("type").over(of_zone).alias("type"), "min", "max", "buckets",
        (F.sum("zones").over(of_zone) > 0).alias("known"),
        F.sum("buckets").over(of_zone).alias("zone_buckets"), F.sum("zones").over(of_activity).alias("activity_zones"),
        (F.row_number().over(of_zone.orderBy("min", "max")) == 1).alias("zone_first"),
        (F.row_number().over(of_activity.orderBy("zone_seq_no", "min", "max")) == 1).alias("activity_first"),
    )

    def report(name: str, count: str, *told: str) -> Column:
        return F.struct(
            F.lit(name).alias("report"), F.col(count).alias("count"),
            *[(F.col(c) if c in told else F.lit(None).cast(kind)).alias(c) for c, kind in (("type", "string"), ("min", "int"), ("max", "int"))],
        )

    known, zone_first = F.col("known"), F.col("zone_first") & (F.col("zone_buckets") > 0)
    reports = F.array_compact(
        F.array(
            F.when(F.col("activity_first") & (F.col("activity_zones") > 0), report("zones_per_activity", "activity_zones")),
            F.when(zone_first, report("buckets_per_zone", "zone_buckets")),
            F.when(zone_first & known, report("buckets_per_zone_by_type", "zone_buckets", "type")),
            F.when(known & (F.col("buckets") > 0), report("range_counts", "buckets", "type", "min", "max")),
        )
    )
    names = ["report", "type", "min", "max", "count"]
    return typed.select(F.inline(reports)).groupBy(*names).agg(F.count("*").alias("groups"))
