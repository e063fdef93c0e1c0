"""Normalised records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.functions.text import address_fields, name_fields, text

NAME = ["name_norm", "name_core", "name_key", "name_compact", "legal", "name_is_domain", "name_script"]
ADDRESS = ["addr_norm", "addr_key", "house_no", "numbers", "postal", "state", "addr_empty"]
RECORD = ["entity_id", "country", *NAME, *ADDRESS]


def staged(df: DataFrame, layers: list[dict[str, Column]], keep: list[str]) -> DataFrame:
    """Add layers of fields, so that each field is computed once, and drop those not kept."""
    for layer in layers:
        df = df.withColumns(layer)
    return df.drop(*[n for layer in layers for n in layer if n not in keep])


def with_name(df: DataFrame, column: str = "business_name") -> DataFrame:
    return staged(df, name_fields(F.col(column)), NAME)


def with_address(df: DataFrame, column: str = "business_address") -> DataFrame:
    return staged(df, address_fields(F.col(column)), ADDRESS)


def normalize(records: DataFrame) -> DataFrame:
    """The normal forms of (entity_id, business_name, business_address, country) records."""
    out = with_address(with_name(records)).withColumn("country", F.trim(text(F.col("country"))))
    return out.select(*RECORD)
