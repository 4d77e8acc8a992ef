"""Customer change history: the id and the current row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]

UPDATED = "dynamodb_new_image_updated_at_n"
CREATED = "dynamodb_approximate_creation_date_time"
STATUS = "dynamodb_new_image_status_s"
COUNTRY = "dynamodb_new_image_individual_m_address_m_country_code_s"
BRAND = "dynamodb_new_image_brand_id_s"
ID_COLUMNS = ("dynamodb_key_id_s", "dynamodb_keys_id_s", "dynamodb_new_image_id_s")


def customer_id(df: DataFrame, columns: Sequence[str] = ID_COLUMNS) -> Column:
    """First id column that holds a value."""
    return F.coalesce(*[F.col(c) for c in columns if c in df.columns])


def change_order(df: DataFrame) -> list[str]:
    """Newest-change order; further stamps break ties where the history carries them."""
    return [c for c in (UPDATED, CREATED, "timestamp_extracted") if c in df.columns]
