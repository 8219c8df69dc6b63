"""Dense surrogate keys and ranks within groups, without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .skew import HOT_ROWS, fan_out, hot_keys, key_hash

# monotonically_increasing_id() puts the partition above bit 33 and the row's place below.
PLACE_BITS = 33
# Copies of one row are written back in runs of this length.
RUN = 10_000


def surrogate_key(df: DataFrame, name: str, order: Sequence[str], dtype: str = "int") -> DataFrame:
    """Number the rows 1..n in ascending `order`, nulls first; `order` must be unique in `df`.

    Equal to `row_number()` over one global window, but sorted by range partitions: a row's number
    is its place in its partition plus the size of all earlier partitions. The placed rows are
    stored, so that sizes and places come from one and the same partitioning. Only the partition
    sizes, one number per partition, come to the driver.
    """
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", PLACE_BITS)
    place = F.col("_at").bitwiseAND((1 << PLACE_BITS) - 1)
    sizes = dict(placed.groupBy(part).count().collect())
    starts = accumulate((sizes.get(p, 0) for p in range(max(sizes, default=0))), initial=0)
    before = F.element_at(F.expr(f"array({', '.join(f'{n}L' for n in starts)})"), (part + 1).cast("int"))
    return placed.select((before + place + 1).cast(dtype).alias(name), *df.columns)


def rank_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "rank",
    keep: int | None = None,
    hot: dict[int, int] | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add `row_number()` within `group` by ascending `order`.

    With `keep`, only ranks up to `keep` are returned, and Spark cuts each group to `keep` rows
    before it shuffles, so no group can grow large. Without it every row is kept: groups beyond
    an average partition's share are sorted over several tasks, the others by the plain window.
    `hot` may bring the `hot_keys` of `group` when they are known.
    """
    row_number = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    if keep is not None:
        cut_up_to = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
        ranked = df.withColumn(name, row_number) if keep <= cut_up_to else rank_in_group(df, group, order, name, None, hot, min_rows)
        return ranked.filter(F.col(name) <= keep)
    hot = hot_keys(df, group, min_rows) if hot is None else hot
    if not hot:
        return df.withColumn(name, row_number)
    large = key_hash(group).isin(*hot)
    usual, split = df.filter(~large), df.filter(large)
    return usual.withColumn(name, row_number).unionByName(_rank_split(split, group, order, name))


def _same_group(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _rank_split(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Ranks for few, very large groups.

    Copies of a row are first folded into one row with a count, then all rows are range-partitioned
    by group and order, which cuts a group into as many partitions as it needs. A row's rank
    is the running count in its partition plus the counts of the group's earlier partitions.
    """
    rest = [c for c in df.columns if c not in (*group, *order)]
    # Maps and variants cannot be grouped or sorted by: their JSON text stands for them, one row of each text keeps the value.
    loose = [c for c in rest if any(k in df.schema[c].dataType.simpleString() for k in ("map<", "variant"))]
    text = {c: f"_text_{i}" for i, c in enumerate(loose)}
    keys = [c for c in df.columns if c not in loose]
    values = [F.first(c).alias(c) for c in loose]
    folded = df.withColumns({t: F.to_json(F.struct(c)) for c, t in text.items()})
    folded = folded.groupBy(*keys, *text.values()).agg(F.count("*").alias("_n"), *values)
    rest = [text.get(c, c) for c in rest]
    placed = materialize(
        folded.repartitionByRange(*group, *order, *rest).withColumn("_part", F.spark_partition_id())
    )
    # A partition boundary adds one row to this frame, a group one: below two per partition.
    in_group = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy(*group, "_part")
        .agg(F.sum("_n").alias("_rows"))
        .select(*group, "_part", F.coalesce(F.sum("_rows").over(in_group), F.lit(0)).alias("_before"))
    )
    in_part = (
        Window.partitionBy("_part", *group)
        .orderBy(*order, *rest)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counted = placed.withColumn("_here", F.coalesce(F.sum("_n").over(in_part), F.lit(0)))
    before = F.broadcast(before)
    started = counted.join(before, _same_group(counted, before, [*group, "_part"])).select(
        *[counted[c] for c in df.columns], "_n", (F.col("_before") + F.col("_here")).alias("_start")
    )
    # Unfold the copies in two steps, spread in between, so that no array or task gets them all.
    runs = started.withColumn("_run", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {RUN}"))))
    first = F.col("_run") * RUN + 1
    last = F.least((F.col("_run") + 1) * RUN, F.col("_n"))
    return (
        runs.repartition(fan_out(df), "_start", "_run")
        .select(*df.columns, F.explode(F.sequence(F.col("_start") + first, F.col("_start") + last)).alias(name))
        .withColumn(name, F.col(name).cast("int"))
    )
