"""City event feeds: raw rows to trusted rows to one shared event table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.functions import numeric, postal, temporal, text
from citylake.operators import schema as S
from citylake.operators.dedupe import dedupe, latest_per_key
from citylake.operators.enrich import translate
from citylake.operators.filters import (
    POSITION_FLAG, has_position, query_events, with_categories, with_position_flag,
)

# Columns of every exploitation table, before the point and the labels.
EVENT_COLUMNS = [
    "id", "name", "description", "address", "email", "website", "city", "longitude", "latitude",
    "start_date", "end_date",
]
NOT_AVAILABLE = "not avl"

# Source column to shared column, per city.
ROME_NAMES = {
    "id_": "id",
    "Denominazione": "name",
    "Descrizione": "description",
    "Indirizzo": "address",
    "Mail": "email",
    "Sito web": "website",
    "Longitudine": "longitude",
    "Latitudine": "latitude",
}
PARIS_NAMES = {
    "ID": "id",
    "Titre": "name",
    "Description": "description",
    "Adresse du lieu": "address",
    "URL": "website",
    "Ville": "city",
    "Date de début": "start_date",
    "Date de fin": "end_date",
}
BARCELONA_NAMES = {
    "register_id": "id",
    "values_description": "description",
    "addresses_main_address": "address",
    "geo_epgs_4326_lon": "longitude",
    "geo_epgs_4326_lat": "latitude",
}
MADRID_NAMES = {
    "ID-EVENTO": "id",
    "TITULO": "name",
    "DESCRIPCION": "description",
    "NOMBRE-VIA-INSTALACION": "address",
    "CONTENT-URL": "website",
    "LATITUD": "latitude",
    "LONGITUD": "longitude",
    "FECHA": "start_date",
    "FECHA-FIN": "end_date",
}

# Columns with special handling.
PARIS_TEXT = [
    "Titre", "Chapeau", "Description", "Description de la date", "Nom du lieu",
    "Adresse du lieu", "Ville", "Transport", "Détail du prix", "Texte alternatif de l'image",
    "Crédit de l'image",
]
PARIS_POSITION = "Coordonnées géographiques"
ROME_TRANSLATED = [
    "Modalità di gestione", "Partner", "Tipologia di utilizzo", "Denominazione", "Descrizione",
]
MADRID_NUMBERS = [
    "CODIGO-POSTAL-INSTALACION", "NUM-INSTALACION", "COORDENADA-X", "COORDENADA-Y", "LATITUD",
    "LONGITUD",
]


def _strings(df: DataFrame, exclude: list[str] | str | None = None) -> list[str]:
    return S.pick_columns(df, dtype="string", exclude=exclude)


def _on(df: DataFrame, names: list[str], fn: Callable[[Column], Column]) -> DataFrame:
    return S.apply_by_name(df, {n: fn for n in names})


def _finish(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Shared columns, point and category labels."""
    absent = [c for c in ("email", "website") if c not in names.values()]
    read = S.rename_select(df, names, [c for c in EVENT_COLUMNS if c not in absent])
    shared = S.ensure_columns(read, absent, NOT_AVAILABLE).select(EVENT_COLUMNS)
    point = numeric.point_wkt("longitude", "latitude")
    return with_categories(shared.withColumn("Point", point).drop("longitude", "latitude"))


def rome_trusted(df: DataFrame, null_keys: str = "collapse") -> DataFrame:
    # Coordinates first: the text rules would put a space into a decimal number.
    df = _on(df, ["Latitudine", "Longitudine"], numeric.to_numeric)

    def tidy(c: Column) -> Column:
        return text.slash_to_null(text.norm(text.fix_text(c), collapse=True))

    rules = {c: tidy for c in _strings(df)}
    rules["Denominazione"] = text.slash_to_null
    rules["Descrizione"] = lambda c: text.slash_to_null(text.spell_dates(text.end_phrase(c)))
    # Keys are cleaned and duplicates dropped before the other texts are touched.
    keys = ["Denominazione", "id_"]
    df = S.apply_by_name(df, {k: rules.pop(k) for k in keys if k in rules})
    order = [c for c in ("id_", "_id") if c in df.columns]
    for key in keys:
        if key in df.columns:
            df = dedupe(df, [key], [c for c in order if c != key] or None, null_keys)
    return S.apply_by_name(df.drop("_id"), rules)


def rome_events(trusted: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    df = has_position(trusted, "Latitudine", "Longitudine")
    df = S.apply_by_name(
        df,
        {"Mail": text.extract_mails, "Zona Wi-Fi": partial(text.map_values, mapping={"si": "yes"})},
    )
    df = translate(df, [c for c in ROME_TRANSLATED if c in df.columns], dictionary)
    return _finish(S.open_validity(df), ROME_NAMES)


def paris_trusted(df: DataFrame, null_keys: str = "collapse", id_pattern: str = "(id|code)") -> DataFrame:
    # Keys are cast and duplicates dropped before the texts are cleaned.
    df = S.apply_to(df, numeric.to_long, id_pattern, exclude=PARIS_TEXT)
    ids = S.pick_columns(df, "id", exclude=PARIS_TEXT)
    if ids:
        df = dedupe(df, ids, null_keys=null_keys)
    df = _on(df, PARIS_TEXT, lambda c: text.fix_french(text.html_text(c)))
    df = S.apply_to(df, temporal.parse_ts, "date")
    position = numeric.split_latlon(S.named(PARIS_POSITION))
    df = df.withColumns({"latitude": position["lat"], "longitude": position["lon"]})
    return _on(df, _strings(df, ["Titre", "Description"]), text.norm)


def paris_events(trusted: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    df = has_position(trusted, "latitude", "longitude")
    if {"Code postal", "Ville"} <= set(df.columns):
        df = df.withColumn("Code postal", postal.paris_postcode("Code postal", "Ville"))
    df = S.apply_to(df, text.valid_url, "url", "string")
    df = S.apply_to(df, text.valid_mail, "mail", "string")
    used = [n for n in PARIS_NAMES if n in _strings(df, "(dat|téléphone|url|mail)")]
    return _finish(translate(df, used, dictionary), PARIS_NAMES)


def barcelona_trusted(df: DataFrame, id_pattern: str = "(id|number|code)") -> DataFrame:
    df = S.apply_to(df, lambda c: c.cast("string"))
    df = S.apply_to(df, temporal.parse_ts, "(dat|created|modified)")
    df = _on(df, ["register_id"], numeric.to_long)
    df = latest_per_key(df, "register_id", "created", [c for c in ("modified", "name") if c in df.columns])
    df = S.apply_to(df, numeric.to_long, id_pattern)
    names = S.pick_columns(df, "name", "string")
    others = _strings(df, names)
    return S.apply_by_name(df, {n: text.fix_spanish for n in names} | {n: text.norm for n in others})


def barcelona_events(
    trusted: DataFrame, dictionary: DataFrame | None = None, only_positioned: bool = False
) -> DataFrame:
    """Rows without coordinates are flagged but stay unless ``only_positioned``."""
    lat, lon = (S.named(c).try_cast("double") for c in ("geo_epgs_4326_lat", "geo_epgs_4326_lon"))
    df = with_position_flag(trusted, lat, lon)
    if only_positioned:
        df = df.where(F.col(POSITION_FLAG) == "yes")
    df = df.withColumn(
        "addresses_zip_code", postal.barcelona_postcode("addresses_zip_code", "addresses_town")
    )
    return _finish(
        translate(S.normalise_names(df, lower=False), ["name", "values_description"], dictionary),
        BARCELONA_NAMES,
    )


def madrid_trusted(
    df: DataFrame, title_pattern: str = "(TITULO|DESCRIPTION)", id_pattern: str = "ID",
    null_keys: str = "collapse",
) -> DataFrame:
    df = S.apply_to(df, temporal.parse_ts, "FECHA")
    if "ID-EVENTO" in df.columns:
        df = dedupe(df, ["ID-EVENTO"], null_keys=null_keys)
    df = S.apply_to(df, text.fix_spanish, title_pattern)
    ids = S.pick_columns(df, id_pattern)
    numbers = [c for c in MADRID_NUMBERS if c in df.columns and c not in ids]
    df = S.apply_by_name(df, {c: numeric.to_long for c in ids} | {c: numeric.to_numeric for c in numbers})
    return _on(df, _strings(df, "(fecha|hora|titulo|descripcion)"), text.norm)


def madrid_events(trusted: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    df = S.apply_by_name(
        trusted,
        {"DIAS-SEMANA": text.clean_weekdays, "CODIGO-POSTAL-INSTALACION": postal.madrid_postcode},
    )
    df = has_position(df, "LATITUD", "LONGITUD")
    df = S.apply_to(df, text.valid_url, "url", "string")
    df = S.apply_to(df, text.valid_mail, "mail", "string", exclude="url")
    df = S.normalise_names(df, lower=False)
    return _finish(translate(df, ["TITULO", "DESCRIPCION"], dictionary), MADRID_NAMES)


TRUSTED = {
    "rome": rome_trusted, "paris": paris_trusted, "barcelona": barcelona_trusted,
    "madrid": madrid_trusted,
}
EVENTS = {
    "rome": rome_events, "paris": paris_events, "barcelona": barcelona_events,
    "madrid": madrid_events,
}


def exploitation_tables(
    raw: Mapping[str, DataFrame], dictionary: DataFrame | None = None
) -> dict[str, DataFrame]:
    """``{city}_expl`` for every city whose raw frame has columns to work on."""
    return {
        f"{city}_expl": EVENTS[city](TRUSTED[city](df), dictionary)
        for city, df in raw.items()
        if city in EVENTS
    }


def filtered_events(events: DataFrame, predicate: str = "SOCIAL_LIFE = 1") -> DataFrame:
    return query_events(events, predicate)
