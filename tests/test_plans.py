"""The whole load on made-up landed files: staging, two increments, mart, profile."""

import json
import uuid
import warnings

import pytest
from pyspark.sql import functions as F

from starbuild.operators.quality import QualityError
from starbuild.plans.mart import MartTables, build_mart, doubled_zones, labelled, lookup_losses, zone_columns
from starbuild.plans.profile import profile
from starbuild.plans.schemas import ACTIVITY, MEASURES, RESPONSE, ZONE_SPEC
from starbuild.plans.staging import StagingTables, activities, stage_activity, stage_athlete, stage_children
from starbuild.sources import parse_responses, read_pages, union_pages


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def record(key, **changed):
    """An activity as the source lands it."""
    base = {
        "id": key, "name": f"ride {key}", "distance": 1000.5, "moving_time": 60, "type": "Ride", "sport_type": "Ride",
        "start_date": "2023-06-30T21:30:05Z", "start_date_local": "2023-06-30T23:30:05Z",
        "location_city": "Oslo", "location_state": "Oslo", "location_country": "Norway",
        "start_latlng": [59.5, 10.25], "end_latlng": [], "trainer": False, "athlete": {"id": 9, "resource_state": 1},
        "map": {"id": f"m{key}", "summary_polyline": "abc", "resource_state": 2}, "surprise": {"field": 1},
    }
    return base | changed


def zone(kind, count, score=5, shift=0):
    buckets = [{"min": 10 * i, "max": 10 * (i + 1), "time": 100 * i + shift} for i in range(count)]
    return {"score": score, "type": kind, "resource_state": 3, "sensor_based": True, "points": 1, "custom_zones": False,
            "distribution_buckets": buckets}


POWER, HEART = zone("power", 11), zone("heartrate", 5)


class Load:
    """Landed files in a folder, and tables of its own."""

    def __init__(self, spark, folder):
        name = f"t_{uuid.uuid4().hex}"
        self.spark, self.folder = spark, folder
        self.staging = StagingTables(**{t: f"{name}_{t}" for t in ("athlete", "activity", "zone", "bucket", "no_zone")})
        self.mart = MartTables(**{t: f"{name}_mart_{t}" for t in ("sport_type", "geography", "time", "activity")})

    def activities(self, *pages):
        target = self.folder / uuid.uuid4().hex
        target.mkdir()
        for i, page in enumerate(pages):
            (target / f"page={i + 1}.json").write_text(json.dumps(page))
        return stage_activity(self.spark, str(target), self.staging)

    def answers(self, answers):
        data = [(key, status, body if isinstance(body, str) else json.dumps(body)) for key, status, body in answers]
        stage_children(self.spark, self.spark.createDataFrame(data, RESPONSE), self.staging)

    def table(self, name):
        return self.spark.table(getattr(self.staging, name))

    def fact(self, **options):
        return build_mart(self.spark, self.staging, self.mart, **options)


@pytest.fixture
def load(spark, tmp_path):
    return Load(spark, tmp_path)


def test_activity_staging(load):
    found = load.activities(
        [record(1), record(2, map=None, gear_id=None)], [record(2, average_speed=None), record(3)], []
    )
    expected = load.spark.createDataFrame([], ACTIVITY)
    assert found.dtypes == expected.dtypes and len(found.columns) == 60
    assert sorted(r["id"] for r in found.select("id").collect()) == [1, 2, 2, 3]
    first = found.filter("id = 1").first().asDict()
    assert (first["map.id"], first["athlete.id"], first["start_latlng"], first["end_latlng"]) == ("m1", 9, [59.5, 10.25], [])
    assert (first["distance"], first["moving_time"], first["trainer"], first["commute"]) == (1000.5, 60, False, None)
    assert first["start_date_local"] == "2023-06-30T23:30:05Z"
    assert found.filter("`map.id` is null").count() == 1


def test_activity_text_where_an_int_belongs(load):
    with pytest.raises(Exception, match="column gear_id: value cannot be cast to int"):
        load.activities([record(1, gear_id="g77")])


def test_activity_with_inferred_schema_misses_a_column(load):
    target = load.folder / "inferred"
    target.mkdir()
    (target / "page=1.json").write_text(json.dumps([record(1)]))
    with pytest.raises(ValueError, match="columns missing from the source: .*gear_id"):
        activities(load.spark, str(target), infer=True)


def test_athlete(load):
    path = load.folder / "athlete.json"
    path.write_text(json.dumps({"id": 9, "weight": 70.5, "bikes": None, "city": "Oslo"}))
    found = stage_athlete(load.spark, str(path), load.staging)
    assert dict(found.dtypes) == {"bikes": "string", "city": "string", "id": "bigint", "weight": "double"}
    assert found.count() == 1


def test_pages_keep_duplicates(load):
    one = load.spark.createDataFrame([(1, 2)], "a int, b int")
    two = load.spark.createDataFrame([(1,), (1,)], "a int")
    assert rows(union_pages([one, two])) == [(1, 2), (1, None), (1, None)]
    target = load.folder / "raw"
    target.mkdir()
    (target / "page=1.json").write_text('[{"a": 1}, {"a": 1}]')
    (target / "page=2.json").write_text("[]")
    assert rows(read_pages(load.spark, str(target)).select("a")) == [(1,), (1,)]


def test_increments(load):
    load.activities([record(k) for k in (1, 2, 3, 4)])
    load.answers([(1, 200, [POWER, HEART]), (2, 200, "[]"), (3, 429, "slow down"), (9, 200, [POWER])])
    assert rows(load.table("zone").select("activity_id", "zone_seq_no", "type")) == [(1, 0, "power"), (1, 1, "heartrate")]
    assert load.table("bucket").count() == 16
    assert rows(load.table("no_zone")) == [(2,)]
    # 3 was refused and 4 not asked for: both still pending. 1 and 2 are done, whatever is answered now.
    load.answers([(1, 200, [zone("power", 11, score=99)]), (2, 200, [POWER]), (3, 200, [zone("heartrate", 5), zone("x", 0)])])
    assert rows(load.table("zone").select("activity_id", "zone_seq_no", "score")) == [(1, 0, 5), (1, 1, 5), (3, 0, 5), (3, 1, 5)]
    assert load.table("bucket").count() == 21
    assert rows(load.table("no_zone")) == [(2,)]


def test_empty_increments(load):
    load.activities([record(k) for k in (1, 2)])
    load.answers([])
    load.answers([(1, 200, "[]")])
    load.answers([(1, 200, "[]")])
    assert rows(load.table("no_zone")) == [(1,)]
    assert load.table("zone").count() == load.table("bucket").count() == 0
    load.answers([(2, 200, [HEART])])
    assert load.table("bucket").count() == 5


def test_broken_body_stops_the_load(load):
    load.activities([record(1)])
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        load.answers([(1, 200, '[{"score": ')])
    assert load.table("zone").count() == 0


def test_fact(load):
    load.activities(
        [
            record(1),
            record(2, type="Run", sport_type=None, location_city=None),
            record(3, start_date_local="2008-12-31T10:00:00Z"),
            record(4, location_country=None),
            record(5, start_date_local=None),
            record(6, location_state=None),
        ]
    )
    shuffled = dict(POWER, distribution_buckets=POWER["distribution_buckets"][::-1])
    load.answers([(1, 200, [shuffled, HEART]), (2, 200, [zone("heartrate", 5, score=8, shift=1)]), (6, 200, "[]"), (4, 200, [POWER])])
    fact = load.fact()
    assert len(fact.columns) == 86
    assert fact.columns == [
        "id", *MEASURES, "start_hour", "start_minute", "start_second", "sk_sport_type", "sk_geography", "sk_time",
        *ZONE_SPEC.columns,
    ]
    found = {r["id"]: r.asDict() for r in fact.collect()}
    assert sorted(found) == [1, 2, 6]
    one, two, six = found[1], found[2], found[6]
    assert (one["start_hour"], one["start_minute"], one["start_second"], one["sk_time"]) == (23, 30, 5, "20230630")
    for kind, count in (("power", 11), ("heartrate", 5)):
        for i in range(1, count + 1):
            cells = tuple(one[f"{m}_{kind}{i}"] for m in ("min", "max", "time"))
            assert cells == (10 * (i - 1), 10 * i, 100 * (i - 1))
    assert (one["score_power"], one["zone_type_power"], one["sensor_based_power"], one["custom_zones_power"]) == (5, "power", True, False)
    assert two["score_power"] is None and two["time_power1"] is None and two["zone_type_power"] is None
    assert (two["score_heartrate"], two["zone_type_heartrate"], two["time_heartrate3"]) == (8, "heartrate", 201)
    assert all(six[c] is None for c in ZONE_SPEC.columns)
    types = rows(load.spark.table(load.mart.sport_type))
    assert types == [(1, "Ride", "Ride"), (2, "Run", "N/A")]
    places = rows(load.spark.table(load.mart.geography))
    assert places == [
        (1, "Oslo", "Oslo", None), (2, "Oslo", "N/A", "Norway"), (3, "N/A", "Oslo", "Norway"), (4, "Oslo", "Oslo", "Norway"),
    ]
    assert (one["sk_geography"], two["sk_geography"], six["sk_geography"]) == (4, 3, 2)
    assert (one["sk_sport_type"], two["sk_sport_type"]) == (1, 2)
    # Rebuilding changes nothing, and the country may be labelled too.
    assert rows(load.fact()) == rows(fact)
    filled = load.fact(fill_country=True)
    assert sorted(r["id"] for r in filled.select("id").collect()) == [1, 2, 4, 6]
    named = labelled(load.table("activity"))
    dims = [load.spark.table(t) for t in (load.mart.sport_type, load.mart.geography, load.mart.time)]
    assert rows(lookup_losses(labelled(load.table("activity"), True), *dims)) == [("geography", 0), ("sport_type", 0), ("time", 2)]
    assert named.filter("location_country is null").count() == 1


def test_fact_invariants(load):
    load.activities([record(k) for k in range(1, 8)])
    load.answers([(k, 200, [zone("power", 11, shift=k), zone("heartrate", 5, shift=2 * k)]) for k in range(1, 7)])
    fact = load.fact()
    joined = load.table("zone").join(load.table("bucket"), ["activity_id", "zone_seq_no"])
    for kind, count in ZONE_SPEC.types.items():
        total = fact.select(sum(F.coalesce(F.sum(f"time_{kind}{i}"), F.lit(0)) for i in range(1, count + 1))).first()[0]
        assert total == joined.filter(F.col("type") == kind).agg(F.sum("time")).first()[0]
    assert fact.count() == 7


def test_duplicate_activities_give_duplicate_fact_rows(load):
    load.activities([record(1)], [record(1)])
    load.answers([(1, 200, [HEART])])
    assert rows(load.fact().select("id", "time_heartrate2")) == [(1, 100), (1, 100)]


@pytest.mark.parametrize(
    "answers, reason",
    [
        ([[HEART], [zone("heartrate", 4)]], "groups of different size"),
        ([[zone("speed", 3)]], "type not declared"),
        ([[zone("heartrate", 6)]], "more rows than declared"),
        ([[zone(None, 2)]], "null type"),
    ],
)
def test_fact_gate(load, answers, reason):
    load.activities([record(k) for k in range(1, len(answers) + 1)])
    load.answers([(k, 200, body) for k, body in enumerate(answers, 1)])
    with pytest.raises(QualityError, match=reason):
        load.fact()


def test_fact_with_fewer_buckets_than_declared(load):
    load.activities([record(1)])
    load.answers([(1, 200, [zone("heartrate", 3)])])
    found = load.fact().first()
    assert (found["time_heartrate3"], found["time_heartrate4"]) == (200, None)


def test_two_zones_of_one_type_are_added_up(load):
    load.activities([record(1)])
    load.answers([(1, 200, [zone("power", 11), zone("power", 11, score=7)])])
    with pytest.warns(UserWarning, match="several zones of one type"):
        found = load.fact().first()
    assert (found["time_power3"], found["score_power"]) == (400, 7)
    assert doubled_zones(load.table("zone")).count() == 1


def test_null_bucket_bounds(load, spark):
    from starbuild.plans.schemas import BUCKET_KEY
    from starbuild.sinks import merge_into, overwrite

    open_ended = spark.createDataFrame([(1, 0, 10, None, 5)], "activity_id bigint, zone_seq_no int, min int, max int, time int")
    overwrite(open_ended, load.staging.bucket)
    assert merge_into(load.staging.bucket, open_ended, BUCKET_KEY, ["time"]).count() == 2
    overwrite(open_ended, load.staging.bucket)
    changed = open_ended.withColumn("time", F.lit(6))
    assert rows(merge_into(load.staging.bucket, changed, BUCKET_KEY, ["time"], null_safe=True)) == [(1, 0, 10, None, 6)]


def test_profile(load):
    load.activities([record(k) for k in (1, 2)])
    load.answers([(1, 200, [POWER, HEART]), (2, 200, [zone("heartrate", 5, shift=1)])])
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        load.fact()
    found = {name: rows(df) for name, df in profile(load.table("zone"), load.table("bucket")).items()}
    assert found["row_counts"] == [("bucket", 21), ("zone", 3)]
    assert found["zones_per_activity"] == [(1, 1), (2, 1)]
    assert found["buckets_per_zone"] == [(11, 1), (5, 2)]
    assert found["buckets_per_zone_by_type"] == [("heartrate", 5, 2), ("power", 11, 1)]
    assert len(found["range_counts"]) == 16 and ("heartrate", 0, 10, 1, 2) in found["range_counts"]
    assert len(found["range_counts_top"]) == 16 and found["doubled_zones"] == []


def test_zone_columns_of_large_activities(load, spark):
    """Both ways to place the rows give the same columns."""
    bucket = spark.range(0, 900).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).cast("bigint").alias("activity_id"),
        (F.col("id") % 2).cast("int").alias("zone_seq_no"),
        (F.col("id") % 97).cast("int").alias("min"),
        F.col("id").cast("int").alias("max"),
        (F.col("id") * 3).cast("int").alias("time"),
    )
    zones = bucket.select("activity_id", "zone_seq_no").distinct().select(
        "*", F.lit(1).alias("score"), F.when(F.col("zone_seq_no") == 0, "power").otherwise("heartrate").alias("type"),
        F.lit(2).alias("resource_state"), F.lit(True).alias("sensor_based"), F.lit(3).alias("points"), F.lit(False).alias("custom_zones"),
    )
    usual = zone_columns(zones, bucket)
    large = zone_columns(zones, bucket, min_rows=50)
    assert rows(usual) == rows(large) and len(usual.columns) == 61


def test_a_page_cut_off_stops_the_load(spark, tmp_path):
    (tmp_path / "page=1.json").write_text('[{"id": 1}, {"id": 2}]')
    assert rows(read_pages(spark, str(tmp_path), schema="id string")) == [("1",), ("2",)]
    (tmp_path / "page=2.json").write_text('[{"id": 3}, {"id": 4')
    with pytest.raises(Exception):
        read_pages(spark, str(tmp_path), schema="id string").collect()


def test_a_body_that_is_no_array_stops_the_load(spark):
    answers = spark.createDataFrame([(7, 200, ' [{"score": 1}]'), (8, 200, "[]"), (9, 429, "{}")], "id int, status int, body string")
    assert rows(parse_responses(answers, "id", "array<struct<score:int>>", "zones")) == [(7, [(1,)]), (8, [])]
    with pytest.raises(Exception, match="id 5: the body is not an array"):
        message = spark.createDataFrame([(5, 200, '{"message": "x"}')], answers.schema)
        parse_responses(message, "id", "array<struct<score:int>>", "zones").collect()
