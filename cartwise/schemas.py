"""Declared schemas, keys and length limits of the marketplace tables."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column names, types, keys and VARCHAR lengths of the source data.
# Timestamps carry no zone, so they are TIMESTAMP_NTZ throughout.

S, I, L, D, TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


@dataclass(frozen=True)
class Entity:
    """One table: schema, primary key, VARCHAR limits, foreign keys to other tables."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    foreign_keys: tuple[tuple[str, str, str], ...] = ()  # (column, parent table, parent column)
    multiline: bool = False  # quoted line breaks occur in the CSV
    counts: tuple[str, ...] = ()  # whole numbers kept as text


ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            "customers",
            _struct(customer_id=S, customer_unique_id=S, customer_zip_code_prefix=S, customer_city=S, customer_state=S),
            ("customer_id",),
            {"customer_id": 100, "customer_unique_id": 100, "customer_city": 50, "customer_state": 2},
            (("customer_zip_code_prefix", "geolocation_bis", "geolocation_zip_code_prefix"),),
        ),
        Entity(
            "orders",
            _struct(
                order_id=S,
                customer_id=S,
                order_status=S,
                order_purchase_timestamp=TS,
                order_approved_at=TS,
                order_delivered_carrier_date=TS,
                order_delivered_customer_date=TS,
                order_estimated_delivery_date=TS,
            ),
            ("order_id",),
            {"order_id": 32, "customer_id": 32, "order_status": 32},
            (("customer_id", "customers", "customer_id"),),
        ),
        Entity(
            "order_items",
            _struct(order_id=S, order_item_id=I, product_id=S, seller_id=S, shipping_limit_date=TS, price=D),
            ("order_id", "order_item_id"),
            {"order_id": 32, "product_id": 32, "seller_id": 32},
            (
                ("seller_id", "sellers", "seller_id"),
                ("product_id", "products", "product_id"),
                ("order_id", "orders", "order_id"),
            ),
        ),
        Entity(
            "order_payments",
            _struct(order_id=S, payment_sequential=I, payment_type=S, payment_value=D),
            ("order_id", "payment_sequential"),
            {"order_id": 32, "payment_type": 32},
            (("order_id", "orders", "order_id"),),
        ),
        Entity(
            "order_reviews",
            _struct(
                review_id=S,
                order_id=S,
                review_comment_title=S,
                review_comment_message=S,
                review_creation_date=TS,
                review_answer_timestamp=TS,
            ),
            ("review_id", "order_id"),
            {"review_id": 32, "order_id": 32, "review_comment_title": 100, "review_comment_message": 500},
            (("order_id", "orders", "order_id"),),
            multiline=True,
        ),
        Entity(
            "products",
            _struct(
                product_id=S,
                product_category_name=S,
                product_name_lenght=S,
                product_description_lenght=S,
                product_photos_qty=S,
            ),
            ("product_id",),
            {
                "product_id": 32,
                "product_category_name": 50,
                "product_name_lenght": 50,
                "product_description_lenght": 50,
                "product_photos_qty": 50,
            },
            counts=("product_name_lenght", "product_description_lenght", "product_photos_qty"),
        ),
        Entity(
            "sellers",
            _struct(seller_id=S, seller_zip_code_prefix=S, seller_city=S, seller_state=S),
            ("seller_id",),
            {"seller_id": 32, "seller_city": 50, "seller_state": 2},
            (("seller_zip_code_prefix", "geolocation_bis", "geolocation_zip_code_prefix"),),
        ),
        Entity(
            "geolocation",
            _struct(
                geolocation_zip_code_prefix=S,
                geolocation_lat=D,
                geolocation_lng=D,
                geolocation_city=S,
                geolocation_state=S,
            ),
            (),
            {"geolocation_city": 50, "geolocation_state": 2},
        ),
        Entity(
            "geolocation_bis",
            _struct(
                geolocation_zip_code_prefix=S,
                geolocation_lat=D,
                geolocation_lng=D,
                geolocation_city=S,
                geolocation_state=S,
                n=I,
            ),
            ("geolocation_zip_code_prefix",),
            {"geolocation_zip_code_prefix": 32, "geolocation_city": 50, "geolocation_state": 2},
        ),
        Entity(
            "brazil_states",
            _struct(
                abbreviation=S,
                state=S,
                capitol_city=S,
                region=S,
                size_km2=L,
                population_2007=L,
                perc_pop_urb=D,
                municipal_districts=L,
                per_capita_gnp=L,
                life_expectancy=D,
            ),
            ("abbreviation",),
        ),
        Entity(
            "product_category_name_translation",
            _struct(product_category_name=S, product_category_name_english=S),
            ("product_category_name",),
            {"product_category_name": 100, "product_category_name_english": 100},
        ),
    )
}

# Further names of tables.
ALIASES = {"states": "brazil_states", "translation": "product_category_name_translation"}
_NAMES = {name: name for name in ENTITIES} | ALIASES


def _base(table: str) -> str:
    """The name without numbers behind it: ``orders_2017`` holds orders."""
    return re.sub(r"(_\d+)+$", "", table)


def shared_prefixes(tables: list[str]) -> set[str]:
    """Prefixes that tables of at least two entities carry, as in ``shop_orders`` and ``shop_customers``."""
    found: dict[str, set[str]] = {}
    for table in map(_base, tables):
        ends = [n for n in _NAMES if table.endswith(f"_{n}")]
        if ends:
            longest = max(ends, key=len)
            found.setdefault(table.removesuffix(longest), set()).add(_NAMES[longest])
    return {prefix for prefix, entities in found.items() if len(entities) > 1}


def entity_for(table: str, prefixes: set[str] | tuple[str, ...] = ()) -> Entity | None:
    """The declared table that a table name stands for, whole or behind one of the prefixes; None if unknown."""
    base = _base(table)
    for prefix in ("", *prefixes):
        if base.startswith(prefix) and base.removeprefix(prefix) in _NAMES:
            return ENTITIES[_NAMES[base.removeprefix(prefix)]]
    return None
