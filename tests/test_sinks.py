"""Tables of the catalog: replacing, creating, merging."""

import uuid

import pytest
from pyspark.sql import functions as F

from starbuild.operators.quality import QualityError
from starbuild.sinks import SchemaMismatch, ensure_table, merge_into, overwrite


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def files(spark, name):
    return set(spark.table(name).inputFiles())


def frame(spark, data, schema="k int, v string"):
    return spark.createDataFrame(data, schema)


def test_overwrite_creates_and_replaces(spark, name):
    assert rows(overwrite(frame(spark, [(1, "a")]), name)) == [(1, "a")]
    assert rows(overwrite(frame(spark, [(2, "b"), (3, None)]), name)) == [(2, "b"), (3, None)]
    assert rows(spark.sql(f"SELECT * FROM {name}")) == [(2, "b"), (3, None)]


def test_overwrite_may_read_the_table_it_replaces(spark, name):
    overwrite(frame(spark, [(1, "a")]), name)
    found = overwrite(spark.table(name).withColumn("k", F.col("k") + 1), name)
    assert rows(found) == [(2, "a")]


def test_overwrite_refuses_another_schema(spark, name):
    overwrite(frame(spark, [(1, "a")]), name)
    with pytest.raises(SchemaMismatch, match="k, w"):
        overwrite(frame(spark, [(1, "a", 2)], "k bigint, v string, w int"), name)
    assert rows(spark.table(name)) == [(1, "a")]
    changed = overwrite(frame(spark, [(1, "a", 2)], "k bigint, v string, w int"), name, allow_schema_change=True)
    assert changed.dtypes == [("k", "bigint"), ("v", "string"), ("w", "int")] and rows(changed) == [(1, "a", 2)]


def test_failed_overwrite_keeps_the_old_rows(spark, name):
    overwrite(frame(spark, [(1, "a")]), name)
    broken = frame(spark, [(2, "b")]).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        overwrite(broken, name)
    assert rows(spark.table(name)) == [(1, "a")]


def test_overwrite_dotted_names(spark, name):
    assert overwrite(frame(spark, [(1, "a")], "`map.id` int, v string"), name).columns == ["map.id", "v"]


def test_ensure_table_is_empty_and_never_truncates(spark, name):
    empty = ensure_table(spark, name, "k int NOT NULL, v string")
    assert empty.dtypes == [("k", "int"), ("v", "string")] and rows(empty) == []
    overwrite(frame(spark, [(1, "a")]), name)
    assert rows(ensure_table(spark, name, "k int NOT NULL, v string")) == [(1, "a")]


def test_merge_appends_when_nothing_matches(spark, name):
    overwrite(frame(spark, [(1, "a")]), name)
    before = files(spark, name)
    assert rows(merge_into(name, frame(spark, [(2, "b")]), ["k"])) == [(1, "a"), (2, "b")]
    assert before < files(spark, name)


def test_merge_updates_and_is_idempotent(spark, name):
    overwrite(frame(spark, [(1, "a"), (2, "b")]), name)
    source = frame(spark, [(2, None), (3, "c")])
    once = rows(merge_into(name, source, ["k"]))
    assert once == [(1, "a"), (2, None), (3, "c")]
    assert rows(merge_into(name, source, ["k"])) == once


def test_merge_insert_only(spark, name):
    overwrite(frame(spark, [(1, "a")]), name)
    source = frame(spark, [(1, "z"), (2, "b")])
    for _ in range(2):
        assert rows(merge_into(name, source, ["k"], update=[])) == [(1, "a"), (2, "b")]


def test_merge_empty_source(spark, name):
    overwrite(frame(spark, [(1, "a")]), name)
    assert rows(merge_into(name, frame(spark, []), ["k"])) == [(1, "a")]


def test_merge_refuses_duplicate_source_keys(spark, name):
    overwrite(frame(spark, [(1, "a")]), name)
    with pytest.raises(QualityError):
        merge_into(name, frame(spark, [(1, "x"), (1, "y")]), ["k"])
    assert rows(spark.table(name)) == [(1, "a")]


def test_merge_rewrites_touched_partitions_only(spark, name):
    schema = "p string, k int, v string"
    overwrite(frame(spark, [("x", 1, "a"), ("x", 2, "b"), ("y", 3, "c")], schema), name, partition_by=["p"])
    untouched = {f for f in files(spark, name) if "p=y" in f}
    found = merge_into(name, frame(spark, [("x", 2, "B"), ("x", 4, "d"), ("z", 5, "e")], schema), ["p", "k"])
    assert rows(found.select("p", "k", "v")) == [("x", 1, "a"), ("x", 2, "B"), ("x", 4, "d"), ("y", 3, "c"), ("z", 5, "e")]
    assert untouched == {f for f in files(spark, name) if "p=y" in f}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_merge_guards_its_partitions(spark, name):
    schema = "p string, k int, v string"
    overwrite(frame(spark, [("x", 1, "a")], schema), name, partition_by=["p"])
    with pytest.raises(ValueError, match="must be among the keys"):
        merge_into(name, frame(spark, [("x", 1, "b")], schema), ["k"])
    with pytest.raises(QualityError, match="null in a partition column"):
        merge_into(name, frame(spark, [("x", 1, "b"), (None, 2, "c")], schema), ["p", "k"])


def test_partitioned_table_can_be_replaced(spark, name):
    schema = "p string, k int"
    overwrite(frame(spark, [("x", 1)], schema), name, partition_by=["p"])
    found = overwrite(frame(spark, [("y", 2), ("z", 3)], schema).select("k", "p"), name, partition_by=["p"])
    assert rows(found.select("p", "k")) == [("y", 2), ("z", 3)]
