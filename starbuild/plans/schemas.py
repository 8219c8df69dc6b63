"""Columns and types of the staging tables (as DDL) and of the star schema."""

from __future__ import annotations

from ..operators.pivot import PivotSpec

# Activity, all columns nullable. Dots are part of the names.
ACTIVITY = """
    resource_state int, name string, distance float, moving_time int, elapsed_time int,
    total_elevation_gain float, type string, sport_type string, id bigint,
    start_date string, start_date_local string, timezone string, utc_offset float,
    location_city string, location_state string, location_country string,
    achievement_count int, kudos_count int, comment_count int, athlete_count int, photo_count int,
    trainer boolean, commute boolean, manual boolean, private boolean, visibility string, flagged boolean,
    gear_id int, start_latlng array<float>, end_latlng array<float>,
    average_speed float, max_speed float, average_cadence float, average_temp float,
    has_heartrate boolean, average_heartrate float, max_heartrate float,
    heartrate_opt_out boolean, display_hide_heartrate_option boolean, elev_high float, elev_low float,
    upload_id bigint, upload_id_str string, external_id string, from_accepted_tag boolean,
    pr_count int, total_photo_count int, has_kudoed boolean, suffer_score float,
    `athlete.id` bigint, `athlete.resource_state` int,
    `map.id` string, `map.summary_polyline` string, `map.resource_state` int,
    average_watts float, max_watts float, weighted_average_watts float, kilojoules float,
    device_watts boolean, workout_type float
"""

ZONE = """
    activity_id bigint NOT NULL, zone_seq_no int NOT NULL, score int, type string,
    resource_state int, sensor_based boolean, points int, custom_zones boolean
"""
ZONE_KEY = ["activity_id", "zone_seq_no"]

BUCKET = "activity_id bigint NOT NULL, zone_seq_no int NOT NULL, min int, max int, time int"
BUCKET_KEY = ["activity_id", "zone_seq_no", "min", "max"]

NO_ZONE = "activity_id bigint"

# Body of a response: the zones of one activity, each with its buckets.
ZONES_BODY = """array<struct<
    score: int, type: string, resource_state: int, sensor_based: boolean, points: int, custom_zones: boolean,
    distribution_buckets: array<struct<min: int, max: int, time: int>>
>>"""

RESPONSE = "activity_id bigint NOT NULL, status int NOT NULL, body string"

# Columns whose nulls are labelled. The country is not among them.
LABELLED = ["type", "sport_type", "location_city", "location_state"]

SPORT_TYPE = {"type": "type", "sport_type": "sport_type"}
SPORT_TYPE_ORDER = ["type", "sport_type"]

GEOGRAPHY = {"location_city": "city", "location_state": "state", "location_country": "country"}
GEOGRAPHY_ORDER = ["country", "state", "city"]

MEASURES = [
    "distance", "moving_time", "elapsed_time", "total_elevation_gain", "comment_count",
    "athlete_count", "photo_count", "average_speed", "max_speed", "average_cadence",
    "average_temp", "average_heartrate", "max_heartrate", "total_photo_count", "suffer_score",
    "average_watts", "max_watts", "weighted_average_watts", "kilojoules",
]

ZONE_SPEC = PivotSpec(
    types={"power": 11, "heartrate": 5},
    attributes={
        "score": "score", "zone_type": "type", "resource_state": "resource_state",
        "sensor_based": "sensor_based", "points": "points", "custom_zones": "custom_zones",
    },
    measures=("min", "max", "time"),
)
