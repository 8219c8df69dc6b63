"""Helpers that several operators share: reading, scratch tables, shingle columns, shipping the package."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbuild.session import materialize, scratch_path, shared_dir

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80

__all__ = [
    "SHINGLE_WORDS",
    "SIMILARITY_PERCENT",
    "any_of",
    "let",
    "materialize",
    "scratch_path",
    "shared_dir",
    "shingle_hashes",
    "ship",
    "table",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, as `--py-files` would."""
    context = spark.sparkContext
    if getattr(context, "_starbuild_sent", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="run-")) / "starbuild_py.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, Path("starbuild") / path.relative_to(package))
    context.addPyFile(str(archive))
    context._starbuild_sent = True


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once for each row, however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(words: Column, width: int = SHINGLE_WORDS) -> Column:
    """64-bit hashes of all runs of `width` words, in order, with repeats.

    `words` is an array of non-empty strings. Fewer words than `width` are one run; none give an empty array.
    """
    long_enough = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.transform(
            F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[h[i + j] for j in range(width)])
        ),
    )
    return (
        F.when(F.size(words) >= width, long_enough)
        .when(F.size(words) > 0, F.array(F.xxhash64(F.concat_ws(" ", words), F.size(words))))
        .otherwise(F.array().cast("array<bigint>"))
    )


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
