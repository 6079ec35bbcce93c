"""Hourly weather documents to the weather table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from citylake.operators import schema as S

# Target schema of one hour.
WEATHER_FIELDS = {
    "timestamp": "str",
    "time": "str",
    "temperature_2m": "float",
    "rain": "float",
    "snowfall": "float",
    "precipitation": "float",
    "cloud_cover": "int",
    "wind_speed_10m": "float",
    "sunshine_duration": "float",
}
RAW_SCHEMA = (
    "hourly struct<time:array<string>,temperature_2m:array<double>,rain:array<double>,"
    "snowfall:array<double>,precipitation:array<double>,cloud_cover:array<bigint>,"
    "wind_speed_10m:array<double>,sunshine_duration:array<double>>"
)


def weather_schema() -> T.StructType:
    return S.schema_from_dict(WEATHER_FIELDS)


def weather_trusted(documents: DataFrame, keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    rows = S.unpivot_hourly(documents.select(*keep, "hourly"))
    schema = weather_schema()
    for name in keep:
        schema = schema.add(name, T.StringType())
    return S.conform(rows, schema)


def weather(trusted: DataFrame, city: str) -> DataFrame:
    return S.tag(trusted, "city_code_name", city)
