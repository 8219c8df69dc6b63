"""Joins that stay balanced when a few keys hold much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Below this many rows a key is left alone: one task handles it easily.
HOT_ROWS = 100_000
# Keys a bucket's sketch may report, and the items it tracks. A bucket is a shuffle partition's share of the keys.
REPORTED, TRACKED = 16, 256
# Salts per partition's share of a hot key: salted keys are placed by hash, and smaller pieces even out better.
SALTS = 4


def fan_out(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> dict[int, int]:
    """Keys holding more than an average partition's share of `df`: key hash to number of salts.

    One pass: keys fall into P buckets, and each bucket has a small heavy-hitter sketch of its own, so
    that no task merges more than one bucket's sketches. With P shuffle partitions at most P keys
    can hold more than 1/P of the rows, so the answer is small whatever the size of `df`. It
    is an estimate, used only to place rows: which keys it lists never changes a result.
    """
    parts = fan_out(df)
    hashed = df.select(key_hash(keys).alias("_hash"))
    buckets = (
        hashed.groupBy(F.pmod("_hash", F.lit(parts)).alias("_bucket"))
        .agg(F.expr(f"approx_top_k(_hash, {REPORTED}, {TRACKED})").alias("top"), F.count("*").alias("n"))
        .collect()
    )
    total = sum(b["n"] for b in buckets)
    top = [x for b in buckets for x in b["top"]]
    return {
        item: SALTS * min(-(-n * parts // total), parts)
        for item, n in top
        if n > min_rows and n * parts > total
    }


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: dict[int, int] | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join of `left` with a `right` that holds about one row per key.

    Without hot keys this is the plain join. Otherwise the rows of a hot left key are dealt over
    several salts by a hash of their other columns and the input partition they come from (which a
    retried task reproduces), and the right row is repeated once per salt, a few repeats per shuffle partition in all.
    The rows are those of the plain join; only their placement differs.

    `hot` may be passed when the keys can be counted on a frame that is cheaper to read.
    `how` is one of inner, left, left_semi, left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    on = list(on)
    # The salt goes by a hash of the key, which differs between types.
    if [left.schema[k].dataType for k in on] != [right.schema[k].dataType for k in on]:
        raise ValueError(f"the keys {on} must have the same types on both sides")
    if how in ("inner", "left_semi"):
        left = left.dropna(subset=on)
    hot = hot_keys(left, on, min_rows) if hot is None else hot
    if not hot:
        return left.join(right, on, how)
    ways = F.broadcast(left.sparkSession.createDataFrame(list(hot.items()), "_hash bigint, _ways int"))
    other = [f.name for f in left.schema.fields if f.name not in on and "map<" not in f.dataType.simpleString()]
    spread = F.xxhash64(F.spark_partition_id(), *other)
    # A null key matches nothing, so such rows may go anywhere.
    unmatched = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    salts = F.when(unmatched, fan_out(left)).otherwise(F.coalesce("_ways", F.lit(1)))
    dealt = (
        left.withColumn("_hash", key_hash(on))
        .join(ways, "_hash", "left")
        .withColumn("_salt", F.pmod(spread, salts))
        .drop("_hash", "_ways")
    )
    repeated = (
        right.withColumn("_hash", key_hash(on))
        .join(ways, "_hash", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_ways", F.lit(1)) - 1)))
        .drop("_hash", "_ways")
    )
    return dealt.join(repeated, [*on, "_salt"], how).drop("_salt")
