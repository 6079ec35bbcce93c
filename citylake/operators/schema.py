"""Schema compilation, flattening, conformance and projection."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.functions.temporal import hour_of

# Schema tokens; any other token means text.
TOKENS = {
    "int": T.IntegerType(),
    "float": T.DoubleType(),
    "str": T.StringType(),
    "bool": T.BooleanType(),
}

VALID_FROM = "2025-01-01"  # fixed values: interval given to undated places
VALID_TO = "9999-12-31"


def name_of(*parts: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in parts)


def named(name: str) -> Column:
    """Column by exact name, also when it holds dots or spaces."""
    return F.col(name_of(name))


def schema_from_dict(spec: Mapping[str, object]) -> T.StructType:
    """Compile ``{name: token}``, ``{name: [token]}``, ``{name: [{..}]}`` to a nullable struct."""

    def type_of(token: object) -> T.DataType:
        if isinstance(token, list):
            inner = token[0]
            return T.ArrayType(schema_from_dict(inner) if isinstance(inner, dict) else type_of(inner))
        return TOKENS.get(token, T.StringType()) if isinstance(token, str) else T.StringType()

    return T.StructType([T.StructField(name, type_of(token), True) for name, token in spec.items()])


def flatten(df: DataFrame, depth: int = 1, in_order: bool = False) -> DataFrame:
    """Lift struct fields to ``parent_child`` columns, ``depth`` levels down.

    By default top-level scalars come first; ``in_order`` keeps the schema order. Arrays stay,
    and so does a struct deeper than ``depth``.
    """

    def leaves(field: T.StructField, path: tuple[str, ...], left: int) -> list[Column]:
        if isinstance(field.dataType, T.StructType) and left > 0:
            return [c for f in field.dataType for c in leaves(f, (*path, f.name), left - 1)]
        return [F.col(name_of(*path)).alias("_".join(path))]

    fields = list(df.schema)
    if not in_order:
        fields.sort(key=lambda f: isinstance(f.dataType, T.StructType))
    return df.select([c for f in fields for c in leaves(f, (f.name,), depth)])


def _is_direct(source: T.DataType, target: T.DataType) -> bool:
    """Types for which a re-read returns the value itself."""
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return source.elementType == target.elementType and _is_direct(
            source.elementType, target.elementType
        )
    same = isinstance(target, tuple({type(t) for t in TOKENS.values()})) and source == target
    return same or (isinstance(source, T.LongType) and isinstance(target, T.IntegerType))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Re-read every row under ``schema``: missing or mistyped fields are null, others dropped.

    Only fields whose type differs go through a JSON document; the rest are taken as they are.
    """
    sources = {f.name: f.dataType for f in df.schema}
    reread = [
        f for f in schema if f.name in sources and not _is_direct(sources[f.name], f.dataType)
    ]
    if reread:
        document = F.to_json(F.struct(*[named(f.name) for f in reread]))
        df = df.withColumn("_row", F.from_json(document, T.StructType(reread)))

    def value(f: T.StructField) -> Column:
        if f.name not in sources:
            return F.lit(None).cast(f.dataType)
        if f in reread:
            return F.col(name_of("_row", f.name))
        return named(f.name).try_cast(f.dataType)

    return df.select([value(f).alias(f.name) for f in schema])


def tag(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def rename_select(df: DataFrame, mapping: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    """Project the columns of ``order`` (new names); names not in ``mapping`` keep theirs."""
    source = {new: old for old, new in mapping.items()}
    return df.select([named(source.get(new, new)).alias(new) for new in order])


def normalise_names(df: DataFrame, lower: bool = True) -> DataFrame:
    return df.toDF(*[c.strip().lower() if lower else c.strip() for c in df.columns])


def pick_columns(
    df: DataFrame,
    name_regex: str = "",
    dtype: str | None = None,
    exclude: Iterable[str] | str | None = None,
) -> list[str]:
    """Names matching a case-insensitive substring pattern and a type.

    ``exclude`` is a list of names or another such pattern.
    """
    wanted = re.compile(name_regex, re.IGNORECASE)
    if isinstance(exclude, str):
        unwanted = re.compile(exclude, re.IGNORECASE)
        skip = {c for c in df.columns if unwanted.search(c)}
    else:
        skip = set(exclude or ())
    return [
        c for c, t in df.dtypes if wanted.search(c) and c not in skip and (dtype is None or t == dtype)
    ]


def apply_to(
    df: DataFrame,
    fn: Callable[[Column], Column],
    name_regex: str = "",
    dtype: str | None = None,
    exclude: Iterable[str] | str | None = None,
) -> DataFrame:
    """Apply one column function to all picked columns in a single projection."""
    picked = set(pick_columns(df, name_regex, dtype, exclude))
    return df.select([fn(named(c)).alias(c) if c in picked else named(c) for c in df.columns])


def apply_by_name(df: DataFrame, fns: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Apply a function per column; columns the frame lacks are skipped."""
    return df.select(
        [fns[c](named(c)).alias(c) if c in fns else named(c) for c in df.columns]
    )


def try_cast(dtype: str) -> Callable[[Column], Column]:
    return lambda c: c.try_cast(dtype)


def ensure_columns(df: DataFrame, names: Iterable[str], default: object = "not avl") -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    return df.withColumns({n: F.lit(default) for n in missing}) if missing else df


def open_validity(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "start_date": F.lit(VALID_FROM).cast("date"),
            "end_date": F.lit(VALID_TO).cast("date"),
        }
    )


def unnest(df: DataFrame, path: str, alias: str = "item") -> DataFrame:
    """One row per element of the array at ``path``; null and empty arrays give none."""
    return df.select(F.explode(path).alias(alias))


def unnest_records(df: DataFrame, path: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Rows of the array of structs at ``path``, projected to ``fields``."""
    rows = df.select(F.inline(path))
    return rows.select([named(f) for f in fields]) if fields else rows


def unpivot_hourly(df: DataFrame, hourly: str = "hourly", time: str = "time") -> DataFrame:
    """Parallel arrays of one struct to rows, up to the shortest array.

    An absent (null) array gives nulls and does not count as shortest.
    ``timestamp`` keeps the original time text; ``time`` becomes ``HH:mm``.
    """
    fields = [f.name for f in df.schema[hourly].dataType]
    arrays = [F.col(name_of(hourly, f)) for f in fields]
    sizes = [F.when(a.isNotNull(), F.size(a)) for a in arrays]
    shortest = F.least(*sizes) if len(sizes) > 1 else sizes[0]
    # arrays_zip is null when one array is; an empty one is padded instead.
    empty = {f.name: F.array().cast(f.dataType) for f in df.schema[hourly].dataType}
    zipped = F.arrays_zip(*[F.coalesce(a, empty[f]).alias(f) for a, f in zip(arrays, fields)])
    others = [c for c in df.columns if c != hourly]
    rows = df.select(
        *[named(c) for c in others],
        F.explode(F.slice(zipped, F.lit(1), F.coalesce(shortest, F.lit(0)))).alias("_hour"),
    )
    values = [
        (hour_of(F.col(name_of("_hour", f))) if f == time else F.col(name_of("_hour", f))).alias(f)
        for f in fields
    ]
    return rows.select(
        *[named(c) for c in others], F.col(name_of("_hour", time)).alias("timestamp"), *values
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, frames)
