"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "starbuild", **conf: str) -> SparkSession:
    """A session with the settings the transforms are written for.

    Sizing (executors, memory, shuffle partitions) is left to the caller:
    pass it in `conf` with ``.`` written as ``__`` or set it at submit time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            named = tempfile.mkdtemp(prefix="starbuild-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Store `df` as Parquet in the shared folder and read it from there.

    Cuts the lineage like a reliable checkpoint, so lost executors cost no recomputation; unlike
    one it is columnar and compressed, and later reads take only the columns they need.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Counted:
    """What a write counts on its way: the rows, and other aggregates by name.

    The counts are taken in the last step before the writer, whose tasks count once however often they are retried. They are
    there once the write has run. An aggregate over no rows is null, and so are all of them if Spark saw beforehand that there are none.
    """

    def __init__(self, **aggregates: Column) -> None:
        self._seen = Observation()
        self._aggregates = {"rows": F.count(F.lit(1)), **aggregates}

    def watch(self, df: DataFrame) -> DataFrame:
        """`df`, counted as it is written."""
        return df.observe(self._seen, *[a.alias(name) for name, a in self._aggregates.items()])

    @property
    def values(self) -> Mapping[str, Any]:
        found = self._seen.get
        return {name: found.get(name, 0 if name == "rows" else None) for name in self._aggregates}

    @property
    def rows(self) -> int:
        return self.values["rows"]


def materialize_counted(df: DataFrame, **aggregates: Column) -> tuple[DataFrame, Mapping[str, Any]]:
    """`materialize`, with its rows (`rows`) and other aggregates counted by the same job."""
    counted = Counted(**aggregates)
    return materialize(counted.watch(df)), counted.values
