"""Accommodation documents to the accommodation table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.functions.text import hash_array
from citylake.operators import schema as S
from citylake.operators.geo import reverse_geocode

# Target schema of one hotel row.
ACCOMMODATION_FIELDS: dict[str, object] = {
    "hotel_id": "int",
    "accessibilityLabel": "str",
    "property_name": "str",
    "property_wishlistName": "str",
    "property_qualityClass": "int",
    "property_isPreferred": "bool",
    "property_reviewCount": "int",
    "property_checkoutDate": "str",
    "property_reviewScore": "float",
    "property_propertyClass": "int",
    "property_checkin_untilTime": "str",
    "property_checkin_fromTime": "str",
    "property_countryCode": "str",
    "property_currency": "str",
    "property_checkout_untilTime": "str",
    "property_checkout_fromTime": "str",
    "property_latitude": "float",
    "property_rankingPosition": "int",
    "property_position": "int",
    "property_blockIds": ["str"],
    "property_mainPhotoId": "int",
    "property_photoHash": ["str"],
    "property_reviewScoreWord": "str",
    "property_isFirstPage": "bool",
    "property_checkinDate": "str",
    "property_ufi": "int",
    "property_id": "int",
    "property_optOutFromGalleryChanges": "int",
    "property_isPreferredPlus": "bool",
    "property_longitude": "float",
    "property_priceBreakdown_taxExceptions": ["unknown"],
    "property_priceBreakdown_excludedPrice_currency": "str",
    "property_priceBreakdown_excludedPrice_value": "float",
    "property_priceBreakdown_benefitBadges": [
        {"variant": "str", "identifier": "str", "text": "str", "explanation": "str"}
    ],
    "property_priceBreakdown_grossPrice_currency": "str",
    "property_priceBreakdown_grossPrice_value": "float",
    "property_priceBreakdown_strikethroughPrice_currency": "str",
    "property_priceBreakdown_strikethroughPrice_value": "float",
    "property_accuratePropertyClass": "int",
}
BADGES = "property_priceBreakdown_benefitBadges"
PHOTOS = "property_photoUrls"

PRICE = "struct<currency:string,value:double>"
RAW_SCHEMA = (
    "data struct<hotels:array<struct<hotel_id:bigint,accessibilityLabel:string,property:struct<"
    "name:string,wishlistName:string,qualityClass:bigint,isPreferred:boolean,reviewCount:bigint,"
    "checkoutDate:string,reviewScore:double,propertyClass:bigint,"
    "checkin:struct<untilTime:string,fromTime:string>,countryCode:string,currency:string,"
    "checkout:struct<untilTime:string,fromTime:string>,latitude:double,rankingPosition:bigint,"
    "position:bigint,blockIds:array<string>,mainPhotoId:bigint,photoUrls:array<string>,"
    "reviewScoreWord:string,isFirstPage:boolean,checkinDate:string,ufi:bigint,id:bigint,"
    "optOutFromGalleryChanges:bigint,isPreferredPlus:boolean,longitude:double,"
    "accuratePropertyClass:bigint,priceBreakdown:struct<taxExceptions:array<string>,"
    f"excludedPrice:{PRICE},grossPrice:{PRICE},strikethroughPrice:{PRICE},"
    "benefitBadges:array<struct<variant:string,identifier:string,text:string,"
    "explanation:string>>>>>>>"
)


def accommodation_schema() -> T.StructType:
    return S.schema_from_dict(ACCOMMODATION_FIELDS)


def hotels(documents: DataFrame, path: str = "data.hotels") -> DataFrame:
    """One row per hotel of every document, as nested fields."""
    return S.unnest(documents, path, "hotel").select("hotel.*")


def accommodation_trusted(documents: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Flat, schema-conformant hotel rows with photo hashes.

    ``keep`` names provenance columns of the documents to carry along.
    """
    keep = keep or []
    rows = documents.select(*keep, F.explode("data.hotels").alias("hotel")).select(*keep, "hotel.*")
    flat = S.flatten(rows, depth=3, in_order=True)
    photos = hash_array(PHOTOS) if PHOTOS in flat.columns else F.lit(None)
    flat = flat.withColumn(
        "property_photoHash", F.coalesce(photos, F.array().cast("array<string>"))
    )
    schema = accommodation_schema()
    for name in keep:
        schema = schema.add(name, T.StringType())
    return S.conform(flat, schema)


def accommodation(
    trusted: DataFrame, places: DataFrame, city: str | None = None, reach: float = 0.01
) -> DataFrame:
    """Exploitation rows: no badges, city code, nearest address."""
    rows = trusted.drop(BADGES)
    value = "property_priceBreakdown_excludedPrice_value"
    rows = rows.withColumn(value, S.named(value).try_cast("double"))
    if city is not None:
        rows = S.tag(rows, "city_code_name", city)
    return reverse_geocode(rows, places, reach=reach)
