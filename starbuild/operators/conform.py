"""Impose a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_struct(schema: T.StructType | str) -> T.StructType:
    """A schema given as such or as DDL text."""
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _source(name: str) -> Column:
    return F.col(f"`{name}`")


def _refuse(condition: Column, message: str) -> Column:
    return F.when(condition, F.raise_error(F.lit(message)))


def _require_columns(df: DataFrame, schema: T.StructType) -> None:
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the source: {', '.join(missing)}")


def _can_fail(source: T.DataType, target: T.DataType) -> bool:
    """Casts between atomic types that a value may refuse."""
    if source in (target, T.NullType()) or isinstance(target, (T.StringType, T.ArrayType, T.StructType, T.MapType)):
        return False
    return not isinstance(source, (T.ArrayType, T.StructType, T.MapType))


INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


# A number as text: sign, digits, fraction, exponent.
NUMBER_TEXT = r"^\s*([+-]?)(\d*)(?:\.(\d*))?(?:[eE]([+-]?\d+))?\s*$"


def _whole_text(source: Column, target: T.DataType) -> Column:
    """Text of a whole number, like 3.0 or 1.2e3, as an integer; null for a fraction. Digits are moved, never rounded."""
    part = lambda i: F.regexp_extract(source, NUMBER_TEXT, i)
    digits = F.concat(part(2), part(3))
    shift = F.when(part(4) == "", 0).otherwise(part(4).try_cast("int")) - F.length(part(3))
    kept = F.length(digits) + shift
    # more than 40 zeros are beyond any integer, unless all digits are zero
    grown = F.rpad(digits, F.length(digits) + F.least(shift, F.lit(40)), F.lit("0"))
    whole = F.when(shift >= 0, grown).when(kept > 0, F.substring(digits, F.lit(1), kept)).otherwise("0")
    exact = (shift >= 0) | F.substring(digits, F.greatest(kept, F.lit(0)) + 1, F.length(digits)).rlike("^0*$")
    return F.when((digits != "") & exact, F.concat(part(1), whole).try_cast(target))


def _cast(source: Column, present: T.DataType, target: T.DataType) -> Column:
    """`source` as `target`, null where it cannot be: 3.0 is an integer, as number or text, and 1.7 is none."""
    value = source.try_cast(target)
    if not isinstance(target, INTEGERS):
        return value
    if isinstance(present, T.StringType):
        return F.coalesce(value, _whole_text(source, target))
    if isinstance(present, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.when(source == F.floor(source), value)
    return value


def conform(df: DataFrame, schema: T.StructType | str, mode: str = "strict") -> DataFrame:
    """Select and cast the columns of `schema`, in its order; other columns are dropped.

    A missing column is an error at once. While the job runs, a null in a NOT NULL column is an
    error, and so is a value that cannot be cast, each naming its column. With mode
    ``"null"`` a value that cannot be cast becomes null; `cast_failures` counts those.
    """
    if mode not in ("strict", "null"):
        raise ValueError(f"unknown mode {mode!r}")
    schema = as_struct(schema)
    _require_columns(df, schema)
    present = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField) -> Column:
        source = _source(field.name)
        if not _can_fail(present[field.name], field.dataType):
            value = source if present[field.name] == field.dataType else source.cast(field.dataType)
        else:
            value = _cast(source, present[field.name], field.dataType)
            if mode == "strict":
                text = f"column {field.name}: value cannot be cast to {field.dataType.simpleString()}"
                value = F.coalesce(value, _refuse(source.isNotNull(), text))
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"column {field.name}: null in a NOT NULL column")))
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def cast_failures(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """One row: for each column of `schema`, how many values cannot be cast."""
    schema = as_struct(schema)
    _require_columns(df, schema)
    present = {f.name: f.dataType for f in df.schema.fields}

    def failures(field: T.StructField) -> Column:
        if not _can_fail(present[field.name], field.dataType):
            return F.lit(0).cast("bigint").alias(field.name)
        source = _source(field.name)
        value = _cast(source, present[field.name], field.dataType)
        return F.count_if(source.isNotNull() & value.isNull()).alias(field.name)

    return df.agg(*[failures(f) for f in schema.fields])


def checked(df: DataFrame, schema: T.StructType | str, reasons: str = "reasons", keep: Sequence[str | Column] = ()) -> DataFrame:
    """`conform` that stops at nothing: `keep`, the columns of `schema`, and an array of what is wrong with the row.

    A value that cannot be cast is null in its column and named in `reasons`, as is a null in a NOT NULL column.
    """
    schema = as_struct(schema)
    _require_columns(df, schema)
    present = {f.name: f.dataType for f in df.schema.fields}
    columns, faults = [], []
    for field in schema.fields:
        source = _source(field.name)
        if _can_fail(present[field.name], field.dataType):
            value = _cast(source, present[field.name], field.dataType)
            text = f"column {field.name}: value cannot be cast to {field.dataType.simpleString()}"
            faults.append(F.when(source.isNotNull() & value.isNull(), text))
        else:
            value = source if present[field.name] == field.dataType else source.cast(field.dataType)
        if not field.nullable:
            faults.append(F.when(source.isNull(), f"column {field.name}: null in a NOT NULL column"))
        columns.append(value.alias(field.name))
    found = F.array_compact(F.array(*faults)) if faults else F.array().cast("array<string>")
    return df.select(*keep, *columns, found.alias(reasons))
