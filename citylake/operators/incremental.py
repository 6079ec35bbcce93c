"""Bookkeeping between zones: what is pending, missing or new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.functions.temporal import departure_day, weather_day
from citylake.operators.dedupe import dedupe
from citylake.operators.joins import lookup
from citylake.operators.schema import named

LEDGER_SCHEMA = "file_key string, inserted_at timestamp, batch string"


def ledger_key(data_type: Column, city: Column, file_name: Column) -> Column:
    return F.concat_ws("/", data_type, city, file_name)


def _without(df: DataFrame, key: str, done: DataFrame, done_key: str) -> DataFrame:
    seen = done.select(named(done_key).alias("_seen")).distinct()
    return lookup(df, seen, {"_seen": named(key)}, "left_anti").select([named(c) for c in df.columns])


def pending(files: DataFrame, ledger: DataFrame, key: str = "file_key") -> DataFrame:
    """Files whose key the ledger does not hold."""
    return _without(files, key, ledger, key)


def missing_in(landing: DataFrame, trusted: DataFrame, path: str = "path") -> DataFrame:
    """Landing rows with no trusted counterpart under the same relative path."""
    return _without(landing, path, trusted, path)


def relative_path(path: Column, zone: str) -> Column:
    """Part of a path below the zone folder."""
    return F.substring_index(path, f"{zone}/", -1)


def new_rows(
    target: DataFrame, new: DataFrame, key: str, order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """Rows of ``new`` to append: one per key, keys of ``target`` left out."""
    return _without(dedupe(new, [key], order_by), key, target, key)


def insert_if_absent(
    target: DataFrame, new: DataFrame, key: str, order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """Target plus the rows of ``new`` with unseen keys; an existing row is never replaced."""
    return target.unionByName(new_rows(target, new, key, order_by))


def missing_vectors(ids: DataFrame, store: DataFrame, key: str = "id") -> DataFrame:
    return _without(ids, key, store, key)


def ledger_read(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table (one folder per batch), empty when nothing was logged yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def ledger_append(ledger: DataFrame, keys: DataFrame, key: str = "file_key") -> DataFrame:
    """Ledger entries to add for unseen keys, stamped with the current time."""
    entries = keys.select(named(key).alias("file_key")).distinct()
    return _without(entries, "file_key", ledger, "file_key").withColumn(
        "inserted_at", F.current_timestamp()
    )


def work_list(
    cities: DataFrame, start: Column | str, end: Column | str, feed: str, city: str = "city"
) -> DataFrame:
    """One row per city and day with landing and trusted paths and the ledger key.

    ``start`` and ``end`` are dates or columns. The days are exploded from each city row, so no
    join takes place.
    """

    def day_of(value: Column | str) -> Column:
        return F.lit(value).cast("date") if isinstance(value, str) else value.cast("date")

    days = F.sequence(day_of(start), day_of(end))
    rows = cities.select(named(city).alias("city"), F.explode(days).alias("day"))
    if feed == "accommodation":
        rows = rows.withColumn("until", departure_day("day"))
        name = F.concat(F.col("day").cast("string"), F.lit("_"), F.col("until").cast("string"))
    else:
        rows = rows.withColumn("until", weather_day("day"))
        name = F.col("until").cast("string")
    key = ledger_key(F.lit(feed), F.col("city"), F.concat(name, F.lit(".json")))
    return rows.withColumn("file_key", key).withColumns(
        {
            "landing_path": F.concat(F.lit("landing_zone/"), F.col("file_key")),
            "trusted_path": F.concat(F.lit("trusted_zone/"), F.col("file_key")),
        }
    )
