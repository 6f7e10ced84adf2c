"""Declared schemas of the three layers and the settings of each entity.

Schemas are never inferred: identifiers such as phone numbers keep their
leading zeros, and a file that does not fit fails instead of being guessed at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from tiermart.functions import MONEY

_S, _L, _D, _TS = T.StringType(), T.LongType(), T.DateType(), T.TimestampNTZType()

# Audit, version and state columns of the layers.
AUDIT_FIELDS = [
    ("_stg_file_name", _S),
    ("_stg_file_load_ts", _TS),
    ("_stg_file_md5", _S),
    ("_copy_data_ts", _TS),
]
AUDIT_COLUMNS = [name for name, _ in AUDIT_FIELDS]
LOAD_TS = "_stg_file_load_ts"
UPDATED_TS = "last_updated_ts"
ACTIVE_FLAG = "is_active"
ACTIVE_VALUE = "yes"
VALID_FROM = "effective_start_date"
VALID_TO = "effective_end_date"
IS_CURRENT = "is_current"


def struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


@dataclass(frozen=True)
class Entity:
    """What the generic pipeline has to know about one entity."""

    name: str
    fields: list[tuple[str, T.DataType]]
    key: list[str]
    # how the curated layer is fed: "versioned" or "insert_only"
    curate: str
    # curated match key and compared attributes of versioned entities
    version_key: list[str] = field(default_factory=list)
    tracked: list[str] = field(default_factory=list)
    drop_null_keys: bool = False
    # columns derived while typing: name -> (type, SQL expression)
    derived: dict[str, tuple[T.DataType, str]] = field(default_factory=dict)
    # child columns -> (parent entity, parent columns)
    foreign_keys: list[tuple[list[str], str, list[str]]] = field(default_factory=list)
    nullable: bool = False
    # quoted line breaks may occur; such files cannot be split between tasks
    multi_line: bool = False

    @property
    def is_dimension(self) -> bool:
        return self.curate == "versioned"

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def typed_fields(self) -> list[tuple[str, T.DataType]]:
        return self.fields + [(n, kind) for n, (kind, _) in self.derived.items()]

    @property
    def typed_columns(self) -> list[str]:
        return [name for name, _ in self.typed_fields]

    @property
    def source_schema(self) -> T.StructType:
        """Columns of the file, all text, bound by position."""
        return struct([(name, _S) for name in self.columns])

    @property
    def raw_schema(self) -> T.StructType:
        return struct([(name, _S) for name in self.columns] + AUDIT_FIELDS)

    @property
    def clean_schema(self) -> T.StructType:
        state = [(UPDATED_TS, _TS)]
        if self.is_dimension:
            state.append((ACTIVE_FLAG, _S))
        return struct(self.typed_fields + state + AUDIT_FIELDS)

    @property
    def curated_schema(self) -> T.StructType:
        versions = (
            [(VALID_FROM, _TS), (VALID_TO, _TS), (IS_CURRENT, T.BooleanType())]
            if self.is_dimension
            else []
        )
        return struct(self.typed_fields + versions + [(UPDATED_TS, _TS)])

    @property
    def raw_table(self) -> str:
        return f"raw_{self.name}"

    @property
    def clean_table(self) -> str:
        return f"clean_{self.name}"

    @property
    def curated_table(self) -> str:
        return f"{'dim' if self.is_dimension else 'fact'}_{self.name}"

    @property
    def required_columns(self) -> list[str]:
        """Columns declared NOT NULL in the clean layer."""
        return [] if self.nullable else self.typed_columns


# Columns, types and keys of the entities.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in [
        Entity(
            name="customers",
            fields=[
                ("customer_id", _L),
                ("name", _S),
                ("gender", _S),
                ("email", _S),
                ("dob", _D),
                ("phone_number", _S),
                ("joining_date", _D),
            ],
            key=["customer_id"],
            curate="versioned",
            version_key=["customer_id"],
            tracked=["name", "gender", "email", "dob", "phone_number", "joining_date"],
        ),
        Entity(
            name="customer_addresses",
            fields=[
                ("address_id", _L),
                ("customer_id", _L),
                ("address", _S),
                ("city", _S),
                ("state", _S),
                ("zip_code", _S),
                ("country", _S),
            ],
            key=["address_id"],
            curate="versioned",
            # an address that moves to another customer opens a second version
            version_key=["address_id", "customer_id"],
            tracked=["address", "city", "state", "zip_code", "country"],
            multi_line=True,
            foreign_keys=[(["customer_id"], "customers", ["customer_id"])],
        ),
        Entity(
            name="locations",
            fields=[
                ("location_id", _L),
                ("city", _S),
                ("state", _S),
                ("country", _S),
                ("latitude", _S),
                ("longitude", _S),
            ],
            key=["location_id"],
            curate="versioned",
            version_key=["location_id"],
            tracked=["city", "state", "country", "latitude", "longitude"],
        ),
        Entity(
            name="products",
            fields=[
                ("product_id", _L),
                ("product_name", _S),
                ("category", _S),
                ("price", MONEY),
                ("stock_quantity", _L),
            ],
            key=["product_id"],
            curate="versioned",
            version_key=["product_id"],
            tracked=["product_name", "category", "price", "stock_quantity"],
            drop_null_keys=True,
        ),
        Entity(
            name="delivery_partners",
            fields=[
                ("delivery_partner_id", _L),
                ("partner_name", _S),
                ("contact_number", _S),
                ("service_area", _S),
            ],
            key=["delivery_partner_id"],
            curate="versioned",
            version_key=["delivery_partner_id"],
            tracked=["partner_name", "contact_number", "service_area"],
        ),
        Entity(
            name="orders",
            fields=[
                ("order_id", _L),
                ("customer_id", _L),
                ("order_date", _D),
                ("order_status", _S),
                ("total_value", MONEY),
                ("address_id", _L),
            ],
            key=["order_id"],
            curate="insert_only",
            foreign_keys=[(["customer_id"], "customers", ["customer_id"])],
        ),
        Entity(
            name="order_items",
            fields=[
                ("order_item_id", _L),
                ("order_id", _L),
                ("product_id", _L),
                ("quantity", MONEY),
                ("price_per_unit", MONEY),
            ],
            key=["order_item_id"],
            curate="insert_only",
            derived={"total_value": (MONEY, "quantity * price_per_unit")},
            foreign_keys=[
                (["order_id"], "orders", ["order_id"]),
                (["product_id"], "products", ["product_id"]),
            ],
        ),
        Entity(
            name="deliveries",
            fields=[
                ("delivery_id", _L),
                ("order_id", _L),
                ("delivery_date", _D),
                ("delivery_status", _S),
                ("delivery_partner_id", _S),
                ("tracking_number", _S),
            ],
            key=["delivery_id"],
            curate="insert_only",
            foreign_keys=[(["order_id"], "orders", ["order_id"])],
        ),
        Entity(
            name="returns",
            fields=[
                ("return_id", _L),
                ("order_id", _L),
                ("product_id", _L),
                ("return_date", _D),
                ("return_reason", _S),
            ],
            key=["return_id"],
            curate="insert_only",
            foreign_keys=[
                (["order_id"], "orders", ["order_id"]),
                (["product_id"], "products", ["product_id"]),
            ],
            nullable=True,
        ),
        Entity(
            name="payments",
            fields=[
                ("payment_id", _L),
                ("order_id", _L),
                ("payment_date", _D),
                ("payment_method", _S),
                ("payment_status", _S),
                ("payment_amount", MONEY),
            ],
            key=["payment_id"],
            curate="insert_only",
            foreign_keys=[(["order_id"], "orders", ["order_id"])],
        ),
    ]
}
