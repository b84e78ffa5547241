"""The typed raw frames the exploration plans work on."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tianguis.sources.raw import typed


@dataclass(frozen=True)
class Frames:
    orders: DataFrame
    order_items: DataFrame
    customers: DataFrame
    payments: DataFrame
    reviews: DataFrame
    products: DataFrame
    sellers: DataFrame
    translation: DataFrame


def typed_frames(raw: Mapping[str, DataFrame]) -> Frames:
    """A2: from the text tables of ``read_raw`` or ``read_staging``."""
    return Frames(
        orders=typed(raw["orders"]),
        order_items=typed(raw["order_items"]),
        customers=typed(raw["customers"]),
        payments=typed(raw["order_payments"]),
        reviews=typed(raw["order_reviews"]),
        products=typed(raw["products"]),
        sellers=typed(raw["sellers"]),
        translation=typed(raw["product_category_translation"]),
    )
