"""The denormalised orders table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.functions import run_timestamp
from tiermart.functions.columns import RunTs
from tiermart.operators.lookup import current_rows
from tiermart.operators.skew import CELL, divide_by, find_cells, no_cells

# Input tables and output columns.
DIMENSIONS = ["products", "customers", "customer_addresses", "delivery_partners"]
FACTS = ["orders", "order_items", "deliveries", "returns"]
DELIVERED = "Delivered"
MASTER_COLUMNS = [
    "order_id",
    "customer_id",
    "order_date",
    "order_status",
    "total_value",
    "address_id",
    "product_id",
    "quantity",
    "price_per_unit",
    "product_name",
    "category",
    "price",
    "stock_quantity",
    "customer_name",
    "gender",
    "customer_dob",
    "phone_number",
    "customer_joining_date",
    "customer_city",
    "customer_state",
    "customer_country",
    "delivery_partner",
    "delivery_partner_contact",
    "delivery_date",
    "delivery_status",
    "return_date",
    "return_reason",
    "product_revenue",
    "data_insert_ts",
    # beyond the first 29: needed by the return rate
    "return_id",
]


def build_master_orders(
    tables: Mapping[str, DataFrame],
    run_ts: RunTs = None,
    current_only: bool = False,
    address_key: str = "customer_id",
    status: str | None = DELIVERED,
    split_hot_keys: bool = True,
) -> DataFrame:
    """Delivered order items with product, customer, address, delivery and return.

    `tables` maps entity names to curated tables. As declared, every version of
    a dimension row joins (`current_only` keeps the current ones) and every
    address of the customer joins (`address_key="address_id"` takes the address
    of the order). `status=None` keeps orders of every status.

    Order of the joins: customers and addresses are attached to the filtered
    orders, where rows are fewest, partners to the deliveries. Items, returns,
    orders and deliveries then meet in one placement by order_id. Products,
    usually small enough to broadcast, come last. Which sides are broadcast is
    left to Spark's own size check, at planning and again at run time, so no
    table is broadcast because somebody assumed it small.

    With `split_hot_keys` a small job first looks for orders, customers,
    products and partners with a large share of the rows; they are divided, see
    `operators.skew`. Without, only Spark's run-time splitting applies.
    """
    t = dict(tables)
    if current_only:
        t.update({name: current_rows(t[name]) for name in DIMENSIONS})

    orders = t["orders"].select(
        "order_id", "customer_id", "order_date", "order_status", "total_value", "address_id"
    )
    if status is not None:
        orders = orders.filter(F.col("order_status") == status)
    customers = t["customers"].select(
        "customer_id",
        F.col("name").alias("customer_name"),
        "gender",
        F.col("dob").alias("customer_dob"),
        "phone_number",
        F.col("joining_date").alias("customer_joining_date"),
    )
    addresses = t["customer_addresses"].select(
        address_key,
        F.col("address_id").alias("address_ref"),
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        F.col("country").alias("customer_country"),
    )
    partners = t["delivery_partners"].select(
        F.col("delivery_partner_id").alias("partner_key"),
        F.col("partner_name").alias("delivery_partner"),
        F.col("contact_number").alias("delivery_partner_contact"),
    )
    deliveries = t["deliveries"].select(
        "delivery_id",
        "order_id",
        "delivery_date",
        "delivery_status",
        # kept as text in the facts, as a number in the dimension
        F.col("delivery_partner_id").cast("bigint").alias("partner_key"),
    )
    items = t["order_items"].select(
        "order_item_id", "order_id", "product_id", "quantity", "price_per_unit"
    )
    returns = t["returns"].select(
        "order_id", "product_id", "return_id", "return_date", "return_reason"
    )
    products = t["products"].select(
        "product_id", "product_name", "category", "price", "stock_quantity"
    )

    # the tables with many rows per key, by the key they join on
    sides = {
        "customer_id": [orders],
        "partner_key": [deliveries],
        "order_id": [items, deliveries, returns],
        "product_id": [items],
    }
    if address_key == "customer_id":
        sides["customer_id"].append(addresses)
    else:
        sides[address_key] = [orders]
    keyed = {key: [(df, [key]) for df in group] for key, group in sides.items()}
    if split_hot_keys:
        cells = find_cells(keyed)
        # along the dimension of the returns both items and returns are divided by
        # product: a pair then meets in one cell, so the outer join stays exact
        cells["order_id"] = divide_by(
            cells["order_id"], items, ["order_id"], ["product_id"], first=2, then=0
        )
    else:
        cells = {key: no_cells(*group[0], len(group)) for key, group in keyed.items()}

    def placed(df: DataFrame, key: str, divided: dict[int, list[str]] | None = None) -> DataFrame:
        return cells[key].place(df, [key], divided or {})

    def on(key: str) -> list[str]:
        return cells[key].on([key])

    named = placed(orders, "customer_id", {0: ["order_id"]}).join(
        placed(customers, "customer_id"), on("customer_id")
    )
    if address_key == "customer_id":
        located = named.join(
            placed(addresses, "customer_id", {1: ["address_ref"]}), on("customer_id")
        )
    else:
        located = placed(named.drop(CELL), address_key, {0: ["order_id"]}).join(
            placed(addresses, address_key), on(address_key)
        )
    located = located.drop("address_ref", CELL)

    delivered = (
        placed(deliveries, "partner_key", {0: ["delivery_id"]})
        .join(placed(partners, "partner_key"), on("partner_key"), "left")
        .drop("partner_key", CELL)
    )

    joined = (
        placed(items, "order_id", {0: ["order_item_id"], 2: ["product_id"]})
        .drop("order_item_id")
        .join(placed(located, "order_id"), on("order_id"))
        .join(
            placed(delivered, "order_id", {1: ["delivery_id"]}).drop("delivery_id"),
            on("order_id"),
        )
        .join(
            placed(returns, "order_id", {2: ["product_id"]}),
            [*on("order_id"), "product_id"],
            "left",
        )
        .drop(CELL)
    )
    return (
        placed(joined, "product_id", {0: ["order_id", "customer_city", "return_id"]})
        .join(placed(products, "product_id"), on("product_id"))
        .withColumn("product_revenue", F.col("price") * F.col("quantity"))
        .withColumn("data_insert_ts", run_timestamp(run_ts))
        .select(*MASTER_COLUMNS)
    )
