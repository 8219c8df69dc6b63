"""Joins of the fact with its dimensions and with aggregated children."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import HOT_ROWS, skew_join

# A dimension up to this many rows is broadcast (a few narrow columns each: tens of MB).
BROADCAST_ROWS = 500_000


def within(df: DataFrame, rows: int) -> bool:
    """Whether `df` has at most `rows` rows."""
    return df.count() <= rows


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    keep: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
    min_rows: int = HOT_ROWS,
    dim_rows: int | None = None,
) -> DataFrame:
    """Inner lookup: add the dimension columns `keep` by the natural key `on` (fact name to dim name).

    Rows that find no dimension row are dropped, and a null in the key finds none. A small `dim` is broadcast, a larger one is joined
    by key with hot keys dealt out. `dim_rows` may bring its size, as counted when it was written; otherwise it
    is counted, and should be a stored frame.
    """
    named = dim.select(*[F.col(d).alias(f) for f, d in on.items()], *keep)
    if dim_rows <= broadcast_rows if dim_rows is not None else within(named, broadcast_rows):
        joined = df.join(F.broadcast(named), list(on), "inner")
    else:
        joined = skew_join(df, named, list(on), "inner", min_rows=min_rows)
    return joined.select(*df.columns, *keep)


def dropped_by_lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str], name: str) -> DataFrame:
    """One row: how many rows of `df` an inner `lookup` would lose."""
    keys = dim.select(*[F.col(d).alias(f) for f, d in on.items()]).distinct()
    counts = df.groupBy(*on).agg(F.count("*").alias("_rows"))
    return counts.join(keys, list(on), "left_anti").agg(
        F.lit(name).alias("lookup"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("dropped_rows")
    )


@dataclass(frozen=True)
class Lookup:
    """A dimension to look up: its natural key (fact name to dim name), the columns to add, and its size if it is known."""

    name: str
    dim: DataFrame
    on: Mapping[str, str]
    keep: Sequence[str] = ()
    rows: int | None = None


def marked_lookups(
    df: DataFrame,
    lookups: Sequence[Lookup],
    mark: str = "missed",
    broadcast_rows: int = BROADCAST_ROWS,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """`df` with the columns of all `lookups` and `mark`, an int whose bit i is set where lookup i found nothing.

    One pass instead of one join for each question: rows with mark 0 are those that inner lookups keep, the
    others are the rejects, each with all that it missed. A null in a key finds nothing.
    """
    if len(lookups) > 31:
        raise ValueError("an int marks 31 lookups at most")
    found = df
    for i, at in enumerate(lookups):
        hit = f"_hit_{i}"
        named = at.dim.select(*[F.col(d).alias(f) for f, d in at.on.items()], *at.keep, F.lit(True).alias(hit))
        small = at.rows <= broadcast_rows if at.rows is not None else within(named, broadcast_rows)
        if small:
            found = found.join(F.broadcast(named), list(at.on), "left")
        else:
            found = skew_join(found, named, list(at.on), "left", min_rows=min_rows)
    bits = F.lit(0)
    for i in range(len(lookups)):
        bits = bits.bitwiseOR(F.when(F.col(f"_hit_{i}").isNull(), 1 << i).otherwise(0))
    return found.select(*df.columns, *[c for at in lookups for c in at.keep], bits.cast("int").alias(mark))


def missed_names(lookups: Sequence[Lookup], mark: str = "missed") -> Column:
    """The names of the lookups that a row missed, in their order."""
    names = [F.when(F.col(mark).bitwiseAND(1 << i) != 0, F.lit(at.name)) for i, at in enumerate(lookups)]
    return F.array_compact(F.array(*names))


def lookup_losses_of(marked: DataFrame, lookups: Sequence[Lookup], mark: str = "missed") -> DataFrame:
    """One row per lookup: how many rows of a marked frame it would drop by itself."""
    counts = [
        F.struct(F.lit(at.name).alias("lookup"), F.count_if(F.col(mark).bitwiseAND(1 << i) != 0).alias("dropped_rows"))
        for i, at in enumerate(lookups)
    ]
    return marked.agg(F.array(*counts).alias("_losses")).select(F.inline("_losses"))


def left_enrich(
    df: DataFrame,
    children: DataFrame,
    key: str,
    child_key: str,
    hot: dict[int, int] | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the columns of `children` (at most one row per key) and keep every row of `df`.

    `hot` may bring the hot keys of `df`, counted on a frame that is cheaper to read.
    """
    named = children.withColumnRenamed(child_key, key)
    return skew_join(df, named, [key], "left", hot=hot, min_rows=min_rows).select(
        *df.columns, *[c for c in named.columns if c != key]
    )
