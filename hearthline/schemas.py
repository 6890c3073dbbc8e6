"""Wire record, curated table and report columns: one definition each."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
}

# Names and types of the 44 flat JSON keys on the wire. Dots are part of a name.
WIRE_FIELDS = {
    "timestamp": "long",
    "zpid": "string",
    "homeStatus": "string",
    "detailUrl": "string",
    "address": "string",
    "streetAddress": "string",
    "city": "string",
    "state": "string",
    "country": "string",
    "zipcode": "string",
    "latitude": "double",
    "longitude": "double",
    "homeType": "string",
    "price": "long",
    "currency": "string",
    "zestimate": "int",
    "rentZestimate": "int",
    "taxAssessedValue": "int",
    "lotAreaValue": "double",
    "lotAreaUnit": "string",
    "bathrooms": "int",
    "bedrooms": "int",
    "livingArea": "int",
    "daysOnZillow": "int",
    "isFeatured": "boolean",
    "isPreforeclosureAuction": "boolean",
    "timeOnZillow": "int",
    "isNonOwnerOccupied": "boolean",
    "isPremierBuilder": "boolean",
    "isZillowOwned": "boolean",
    "isShowcaseListing": "boolean",
    "imgSrc": "string",
    "hasImage": "boolean",
    "brokerName": "string",
    "listingSubType.is_FSBA": "boolean",
    "priceChange": "int",
    "datePriceChanged": "long",
    "openHouse": "string",
    "priceReduction": "string",
    "unit": "string",
    "listingSubType.is_openHouse": "boolean",
    "newConstructionType": "string",
    "listingSubType.is_newHome": "boolean",
    "videoCount": "int",
}

# Columns of the curated table and the wire key each one comes from.
CURATED_FROM_WIRE = {
    "zpid": "zpid",
    "city": "city",
    "hometype": "homeType",
    "price": "price",
    "lotareavalue": "lotAreaValue",
    "bathrooms": "bathrooms",
    "bedrooms": "bedrooms",
    "livingarea": "livingArea",
    "isfeatured": "isFeatured",
    "isshowcaselisting": "isShowcaseListing",
    "newconstructiontype": "newConstructionType",
    "listingsubtype_is_newhome": "listingSubType.is_newHome",
}

# Model inputs.
CATEGORY_COLUMNS = ("city", "hometype", "newconstructiontype")
NUMERIC_COLUMNS = (
    "lotareavalue",
    "bathrooms",
    "bedrooms",
    "livingarea",
    "isfeatured",
    "isshowcaselisting",
    "listingsubtype_is_newhome",
)

KEY = "zpid"
EVENT_TIME = "timestamp"


def wire_schema(
    fields: Iterable[str] | None = None,
    price: str = "long",
    timestamp: str = "long",
) -> StructType:
    """Schema of the wire record, or of the named ``fields`` only.

    The stream reads ``price`` as a double and the batch load as a long; event
    time stays a number here and becomes a timestamp through ``event_time``.
    """
    types = {**WIRE_FIELDS, "price": price, "timestamp": timestamp}
    names = WIRE_FIELDS if fields is None else fields
    return StructType([StructField(name, _TYPES[types[name]]) for name in names])


def curated_schema() -> StructType:
    return StructType(
        [StructField(new, _TYPES[WIRE_FIELDS[old]]) for new, old in CURATED_FROM_WIRE.items()]
    )
