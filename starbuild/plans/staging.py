"""Landed JSON to staging tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.conform import conform
from ..operators.incremental import pending_keys
from ..operators.nested import empty_keys, explode_indexed, explode_inner, flatten_structs
from ..session import materialize
from ..sinks import ensure_table, merge_into, overwrite
from ..sources import (
    flatten_json,
    last_answers,
    load_pages,
    parse_responses,
    read_pages,
    read_record,
    read_schema,
    until_first_refusal,
)
from .schemas import ACTIVITY, BUCKET, BUCKET_KEY, NO_ZONE, ZONE, ZONE_KEY, ZONES_BODY


@dataclass(frozen=True)
class StagingTables:
    athlete: str = "stg_athlete"
    activity: str = "stg_activity"
    zone: str = "stg_zone"
    bucket: str = "stg_bucket"
    no_zone: str = "stg_no_zone"
    rejects: str = "stg_rejects"


def stage_athlete(
    spark: SparkSession, path: str, tables: StagingTables = StagingTables(), root: str | None = None
) -> DataFrame:
    """Replace the athlete table by the one landed record."""
    return overwrite(read_record(spark, path), tables.athlete, root=root)


def stage_athlete_text(
    spark: SparkSession, records: DataFrame, column: str = "body", tables: StagingTables = StagingTables(), root: str | None = None
) -> DataFrame:
    """Replace the athlete table by records that stand as JSON text in `column`; their columns are inferred over all rows."""
    return overwrite(flatten_json(records, column), tables.athlete, allow_schema_change=True, root=root)


def activities(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """The records of a folder of activity pages, flat and typed.

    With `infer` the schema comes from the files in a pass of its own, and a column that no record
    has is then an error; otherwise it is null.
    """
    pages = read_pages(spark, path, None if infer else read_schema(ACTIVITY))
    return conform(flatten_structs(pages), ACTIVITY)


def stage_activity(
    spark: SparkSession,
    path: str,
    tables: StagingTables = StagingTables(),
    infer: bool = False,
    root: str | None = None,
) -> DataFrame:
    """Replace the activity table by the landed pages."""
    return overwrite(activities(spark, path, infer), tables.activity, root=root)


def stage_activity_pages(
    spark: SparkSession,
    path: str,
    tables: StagingTables = StagingTables(),
    require_end: bool = False,
    root: str | None = None,
) -> DataFrame:
    """Replace the activity table by the numbered pages under `path` up to the first empty one.

    Pages and records that do not fit go to the table of rejects, with file, place, key and reason; all others are loaded.
    """
    good, bad = load_pages(spark, path, ACTIVITY, key="id", require_end=require_end)
    overwrite(bad, tables.rejects, root=root)
    return overwrite(good, tables.activity, root=root)


def zones_of(parsed: DataFrame) -> DataFrame:
    """Zone rows of parsed responses, numbered by their place in the response."""
    indexed = explode_indexed(parsed, ["activity_id"], "zones", "zone_seq_no", "zone")
    return conform(indexed.select("activity_id", "zone_seq_no", "zone.*"), ZONE)


def buckets_of(parsed: DataFrame) -> DataFrame:
    """Bucket rows of parsed responses, with the keys of their zone; a zone may have none."""
    indexed = explode_indexed(parsed, ["activity_id"], "zones", "zone_seq_no", "zone")
    return conform(explode_inner(indexed, ["activity_id", "zone_seq_no"], "zone.distribution_buckets"), BUCKET)


def stage_children(
    spark: SparkSession,
    responses: DataFrame,
    tables: StagingTables = StagingTables(),
    null_safe: bool = False,
    root: str | None = None,
    order: Sequence[str] | None = None,
    attempt: str | None = None,
) -> None:
    """Load the zones and buckets of the activities still pending, from stored responses.

    With `order`, the columns by which they were asked for, nothing from the first refusal on is loaded. With `attempt`, a column that
    numbers the answers of a key, its last successful one counts; without it, a key answered twice stops the load.

    Zones are written last: an activity counts as loaded once it has a zone, so a load that breaks
    off before that is taken up again by the next one. An increment without any zones, or
    without any empty answers, is a load like any other.
    """
    zone = ensure_table(spark, tables.zone, ZONE, root=root)
    ensure_table(spark, tables.bucket, BUCKET, root=root)
    no_zone = ensure_table(spark, tables.no_zone, NO_ZONE, root=root)
    pending = pending_keys(
        spark.table(tables.activity).select(F.col("id").alias("activity_id")),
        "activity_id",
        (zone, "activity_id"),
        (no_zone, "activity_id"),
    )
    if order is not None:
        responses = until_first_refusal(responses, order)
    answered = responses.join(pending, "activity_id", "left_semi")
    if attempt is not None:
        answered = last_answers(answered, "activity_id", attempt)
    # Three tables come from it; parse the bodies once.
    parsed = materialize(parse_responses(answered, "activity_id", ZONES_BODY, "zones"))
    merge_into(tables.no_zone, empty_keys(parsed, "activity_id", "zones").distinct(), ["activity_id"], update=[], root=root)
    merge_into(tables.bucket, buckets_of(parsed), BUCKET_KEY, update=["time"], null_safe=null_safe, root=root)
    merge_into(tables.zone, zones_of(parsed), ZONE_KEY, root=root)
