"""Raw entities: declared columns, keys and reading options.

CSV columns are all text; staging gives them their types. The misspelt ``lenght``
columns are the source's own names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Entity:
    name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    # only free text with line breaks needs the whole-file CSV reader
    multi_line: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


_ENTITIES = [
    Entity(
        "orders",
        ("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
         "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"),
        ("order_id",),
    ),
    Entity(
        "order_items",
        ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"),
        ("order_id", "order_item_id"),
    ),
    Entity(
        "customers",
        ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
        ("customer_id",),
    ),
    Entity(
        "sellers",
        ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        ("seller_id",),
    ),
    Entity(
        "products",
        ("product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
         "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"),
        ("product_id",),
    ),
    Entity(
        "category_translation",
        ("product_category_name", "product_category_name_english"),
        ("product_category_name",),
    ),
    Entity(
        "geolocation",
        ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
         "geolocation_state"),
        (),
    ),
    Entity(
        "payments",
        ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
        ("order_id", "payment_sequential"),
    ),
    Entity(
        "reviews",
        ("review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
         "review_creation_date", "review_answer_timestamp"),
        ("review_id", "order_id"),
        multi_line=True,
    ),
]
ENTITIES: dict[str, Entity] = {e.name: e for e in _ENTITIES}

HOLIDAY_RECORD = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("date", "name", "type", "weekday")]
)
