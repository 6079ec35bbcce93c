"""Cultural places of three cities in one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.functions import numeric, postal, text
from citylake.operators import schema as S
from citylake.operators.filters import drop_incomplete

# Output columns and source columns per city.
COLUMNS = ["ID", "Name", "zip_code", "address", "x_coordinate", "y_coordinate", "city"]
BARCELONA = ["_id", "name", "addresses_zip_code", "addresses_road_name", "geo_epgs_25831_x",
             "geo_epgs_25831_y"]
MADRID = ["PK", "NOMBRE", "CODIGO-POSTAL", "NOMBRE-VIA", "COORDENADA-X", "COORDENADA-Y"]
PARIS = ["identifiant", "nom_officiel", "code_postal", "adresse"]
PARIS_POSITION = "coordonnees"


def _clean(df: DataFrame, names: Sequence[str], city: str) -> DataFrame:
    """Project to the shared columns; rows with any gap or an unreadable postcode are dropped."""
    ident, name, code, address, x, y = (S.named(n) for n in names)
    rows = df.select(
        ident.alias("ID"),
        name.alias("Name"),
        postal.pad_zip(code).alias("zip_code"),
        numeric.to_numeric(code).alias("_code"),
        address.alias("address"),
        x.alias("x_coordinate"),
        y.alias("y_coordinate"),
    )
    rows = drop_incomplete(rows)
    return S.tag(
        rows.select(
            "ID",
            text.fold_text("Name").alias("Name"),
            "zip_code",
            text.fold_text("address").alias("address"),
            numeric.round_coord("x_coordinate").alias("x_coordinate"),
            numeric.round_coord("y_coordinate").alias("y_coordinate"),
        ),
        "city",
        city,
    ).select(COLUMNS)


def barcelona_places(df: DataFrame) -> DataFrame:
    return _clean(df, BARCELONA, "Barcelona")


def madrid_places(df: DataFrame) -> DataFrame:
    return _clean(df, MADRID, "Madrid")


def paris_places(df: DataFrame) -> DataFrame:
    scaled = numeric.scaled_coords(PARIS_POSITION)
    rows = df.where(F.col(PARIS_POSITION).isNotNull()).withColumns({"_x": scaled["x"], "_y": scaled["y"]})
    return _clean(rows, [*PARIS, "_x", "_y"], "Paris")


def cultural_places(
    barcelona: DataFrame, madrid: Sequence[DataFrame], paris: DataFrame
) -> DataFrame:
    frames = [barcelona_places(barcelona), paris_places(paris), *[madrid_places(m) for m in madrid]]
    return S.union_all([_texts(f) for f in frames])


def _texts(df: DataFrame) -> DataFrame:
    return df.withColumn("ID", F.col("ID").cast("string"))


def records_table(pages: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Landed API pages to rows: ``result.records`` and ``data`` envelopes."""
    paths = {"result": "result.records", "data": "data"}
    return {name: S.unnest_records(df, paths[next(p for p in paths if p in df.columns)])
            for name, df in pages.items()}
