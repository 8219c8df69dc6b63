"""Replace and merge tables of the session catalog, stored as Parquet.

A rewrite goes to a new folder, and the catalog entry is moved there once every file is written.
So a failed job leaves the old rows in place, and a table may be read while its successor is
written. Earlier folders stay until someone removes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import as_struct
from ..operators.incremental import like, matched_keys, new_rows, require_unique, upsert
from ..operators.quality import require_empty
from ..session import materialize_counted

# An increment up to this many rows (a few narrow columns) is broadcast to its target.
INCREMENT_ROWS = 500_000
# An increment that touches up to this many partitions names them to the scan; beyond, they are found by a join.
NAMED_PARTITIONS = 1_000


class SchemaMismatch(Exception):
    """The frame does not have the columns and types of the table it replaces."""


def _columns(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _new_folder(spark: SparkSession, table: str, root: str | None) -> str:
    *database, name = table.split(".")
    if root is None:
        root = spark.catalog.getDatabase(".".join(database) or spark.catalog.currentDatabase()).locationUri
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _replace(df: DataFrame, table: str, root: str | None, partition_by: Sequence[str]) -> None:
    spark = df.sparkSession
    if not partition_by and spark.catalog.tableExists(table):
        # A partitioned table stays so, as long as its columns are there.
        kept = _partition_columns(spark, table)
        partition_by = kept if set(kept) <= set(df.columns) else ()
    folder = _new_folder(spark, table, root)
    # Without this, each task would write a file for each partition; a partition with many rows is still cut.
    dealt = df.hint("rebalance", *partition_by) if partition_by else df
    dealt.write.partitionBy(*partition_by).parquet(folder)
    known = spark.catalog.tableExists(table)
    partitioned = partition_by or (known and _partition_columns(spark, table))
    if known and not partitioned and _columns(spark.table(table).schema) == _columns(df.schema):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        return
    # Another layout needs a new entry. It is complete before it takes the name, and the old one goes last.
    mark = uuid.uuid4().hex
    successor, old = f"{table}_next_{mark}", f"{table}_old_{mark}"
    entry = successor if known else table
    # The declared schema is given, as an empty folder has none to infer.
    if partition_by:
        stored = T.StructType(
            [f for f in df.schema.fields if f.name not in partition_by] + [df.schema[c] for c in partition_by]
        )
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.fields)
        keys = ", ".join(f"`{c}`" for c in partition_by)
        spark.sql(f"CREATE TABLE {entry} ({columns}) USING parquet PARTITIONED BY ({keys}) LOCATION '{folder}'")
        spark.sql(f"MSCK REPAIR TABLE {entry}")
    else:
        spark.catalog.createTable(entry, path=folder, source="parquet", schema=df.schema)
    if known:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {successor} RENAME TO {table}")
        spark.sql(f"DROP TABLE {old}")


def with_part(df: DataFrame, keys: Sequence[str], parts: int, name: str = "part") -> DataFrame:
    """`df` with the part, 0 to `parts` - 1, that its key falls into by hash: a partition column for tables merged by key.

    Stored by it, with about as many parts as the table should have files, an increment rewrites the parts that hold one of its keys
    and leaves the files of all others. Merge by the part and the key; both loads must name the same `keys` and `parts`. Null
    is a key like any other here.
    """
    return df.withColumn(name, F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))


def overwrite(
    df: DataFrame,
    table: str,
    allow_schema_change: bool = False,
    partition_by: Sequence[str] = (),
    root: str | None = None,
) -> DataFrame:
    """Replace the rows of `table` by `df` and read it back; create it if there is none.

    Other column names or types than the table's are an error unless `allow_schema_change`.
    `root` is the folder to store under, by default that of the database.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and not allow_schema_change:
        old, new = _columns(spark.table(table).schema), _columns(df.schema)
        if old != new:
            changed = sorted(c for c in old.keys() | new.keys() if old.get(c) != new.get(c))
            raise SchemaMismatch(f"{table}: columns differ from the table's: {', '.join(changed)}")
    _replace(df, table, root, partition_by)
    return spark.table(table)


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType | str,
    partition_by: Sequence[str] = (),
    root: str | None = None,
) -> DataFrame:
    """The table, created empty with `schema` if there is none; an existing one is left as it is."""
    if not spark.catalog.tableExists(table):
        _replace(spark.createDataFrame([], as_struct(schema)), table, root, partition_by)
    return spark.table(table)


@contextmanager
def _overwrite_touched_partitions(spark: SparkSession) -> Iterator[None]:
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def merge_into(
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    null_safe: bool = False,
    check: bool = True,
    root: str | None = None,
) -> DataFrame:
    """Merge `source` into `table` by `keys` (see `upsert`) and read it back.

    The work depends on what the increment touches. If no key matches, or nothing is to be updated, the
    new rows are appended and the table's files stay. Otherwise a partitioned table has only
    the partitions of the increment rewritten, for which its partition columns must be among the
    keys; a table without partitions is rewritten whole.
    """
    spark = source.sparkSession
    target = spark.table(table)
    update = [c for c in target.columns if c not in keys] if update is None else list(update)
    # Used several times below, and it may come from a long plan: store it once.
    source, counts = materialize_counted(like(source, target))
    if check:
        require_unique(source, keys, null_safe)
    small = counts["rows"] <= INCREMENT_ROWS
    partition_by = _partition_columns(spark, table)
    by_partition = bool(partition_by) and set(partition_by) <= set(keys)
    part = _touched(target, source, partition_by) if by_partition and not null_safe else target
    if not update:
        new_rows(part, source, keys, null_safe, small).write.insertInto(table)
    elif matched_keys(part, source, keys, null_safe, small).isEmpty():
        source.write.insertInto(table)
    elif partition_by:
        if not by_partition:
            raise ValueError(f"{table}: the partition columns {partition_by} must be among the keys")
        require_empty(
            source.filter(" OR ".join(f"`{c}` IS NULL" for c in partition_by)), "null in a partition column"
        )
        merged = upsert(_touched(target, source, partition_by), source, keys, update, null_safe, check=False, small=small)
        with _overwrite_touched_partitions(spark):
            merged.hint("rebalance", *partition_by).write.insertInto(table, overwrite=True)
    else:
        _replace(upsert(target, source, keys, update, null_safe, check=False, small=small), table, root, ())
    return spark.table(table)


def _touched(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The rows of `target` in the partitions that `source` has rows for; the others are not even listed."""
    touched = source.select(*partition_by).dropna().distinct()
    named = touched.limit(NAMED_PARTITIONS + 1).collect()
    if len(named) > NAMED_PARTITIONS:
        return target.join(touched, list(partition_by), "left_semi").select(*target.columns)
    kinds = [target.schema[c].dataType for c in partition_by]

    def here(row: Row) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"`{c}`") == F.lit(v).cast(k) for c, v, k in zip(partition_by, row, kinds)])

    if len(partition_by) == 1:
        values = [F.lit(row[0]).cast(kinds[0]) for row in named]
        return target.filter(F.col(f"`{partition_by[0]}`").isin(values))
    return target.filter(reduce(lambda a, b: a | b, [here(row) for row in named], F.lit(False)))
