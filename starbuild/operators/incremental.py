"""Find what is still to be loaded, and merge it by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import require_empty
from .skew import hot_keys, skew_join


def pending_keys(parent: DataFrame, key: str, *loaded: tuple[DataFrame, str]) -> DataFrame:
    """Distinct keys of `parent` found in none of the `loaded` frames (frame, its key column).

    Both sides are made distinct before they meet, so a key with many rows travels once, and
    the join reuses that partitioning. A null key of `parent` matches nothing and stays.
    """
    keys = parent.select(key).distinct()
    for frame, name in loaded:
        keys = keys.join(frame.select(F.col(name).alias(key)).distinct(), key, "left_anti")
    return keys


def duplicate_keys(df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Key values that several rows share. Under plain equality a null is never a duplicate."""
    counted = df if null_safe else df.dropna(subset=list(keys))
    return counted.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str], names: Sequence[str], null_safe: bool) -> Column:
    pairs = [(left[k], right[n]) for k, n in zip(keys, names)]
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _hinted(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def matched_keys(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False, small: bool = False
) -> DataFrame:
    """Key values that both frames hold. Reads only the key columns of `target`."""
    have = target.select(*keys)
    wanted = _hinted(source.select(*[F.col(k).alias(f"_k_{k}") for k in keys]), small)
    return have.join(wanted, _on(have, wanted, keys, wanted.columns, null_safe), "left_semi").distinct()


def new_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False, small: bool = False
) -> DataFrame:
    """Rows of `source` whose key `target` lacks.

    `target` is first cut down to the keys of `source`. A small increment is broadcast
    there, and the large table is read without being shuffled.
    """
    found = matched_keys(target, source, keys, null_safe, small)
    if not (small or null_safe):
        return skew_join(source, found, keys, "left_anti").select(*source.columns)
    found = _hinted(found.select(*[F.col(k).alias(f"_k_{k}") for k in keys]), small)
    return source.join(found, _on(source, found, keys, found.columns, null_safe), "left_anti")


def updated_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    null_safe: bool = False,
    small: bool = False,
) -> DataFrame:
    """All rows of `target`; where `source` has the key, the columns `update` take its values, nulls included."""
    changes = source.select(*keys, *[F.col(c).alias(f"_v_{c}") for c in update], F.lit(True).alias("_hit"))
    if small or null_safe:
        changes = _hinted(changes.withColumnsRenamed({k: f"_k_{k}" for k in keys}), small)
        joined = target.join(changes, _on(target, changes, keys, [f"_k_{k}" for k in keys], null_safe), "left")
    else:
        joined = skew_join(target, changes, keys, "left")
    return joined.select(
        *[F.when(F.col("_hit"), F.col(f"_v_{c}")).otherwise(F.col(c)).alias(c) if c in update else c for c in target.columns]
    )


def merged_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """The rows of `updated_rows` and `new_rows` in one full outer join: each side is shuffled once."""
    changes = source.select(*[F.col(c).alias(f"_v_{c}") for c in source.columns], F.lit(True).alias("_hit"))
    old = target.withColumn("_old", F.lit(True))
    joined = old.join(changes, _on(old, changes, keys, [f"_v_{k}" for k in keys], null_safe), "full")

    def value(c: str) -> Column:
        new = F.col("_hit") if c in update else F.col("_old").isNull()
        return F.when(new, F.col(f"_v_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def like(source: DataFrame, target: DataFrame) -> DataFrame:
    """The columns of `target`, in its order and types."""
    return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])


def require_unique(source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> None:
    require_empty(duplicate_keys(source, keys, null_safe), f"several source rows share a key {tuple(keys)}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    null_safe: bool = False,
    check: bool = True,
    small: bool = False,
) -> DataFrame:
    """`target` after merging `source` into it by `keys`.

    Where a key matches, the columns `update` (default: all but the keys) are set from
    `source`; a null there overwrites. Rows with a new key are added whole. With an empty `update`
    only new rows are added. A null in a key matches nothing unless `null_safe`.
    Unless `check` is off, several source rows with one key are an error. Set `small` only for a
    source whose size was checked: it is then broadcast to the target.
    """
    update = [c for c in target.columns if c not in keys] if update is None else list(update)
    source = like(source, target)
    if check:
        require_unique(source, keys, null_safe)
    # A full outer join cannot deal out a hot key, so it is for targets without one.
    if update and not small and not hot_keys(target, keys):
        if null_safe:
            return merged_rows(target, source, keys, update, null_safe)
        # Null keys match nothing; beside the join they cannot all meet in one task.
        unmatched = source.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
        return merged_rows(target, source.dropna(subset=list(keys)), keys, update).unionByName(unmatched)
    kept = updated_rows(target, source, keys, update, null_safe, small) if update else target
    return kept.unionByName(new_rows(target, source, keys, null_safe, small))
