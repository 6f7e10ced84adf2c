"""Commerce entities derived from the generic benchmark tables.

Whole tables throughout. The keys are built so that every case of the wide
table occurs: several items with the same product in an order, customers with
two addresses, open deliveries without a partner, items with and without a
return.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.functions import to_money
from tiermart.operators.dedupe import dedupe_latest
from tiermart.schemas import ENTITIES, IS_CURRENT, VALID_FROM, VALID_TO

LOADED = "2024-01-01 00:00:00"
CLOSED = "2024-02-01 00:00:00"
BUILT = "2024-03-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return dedupe_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(F.col("o_orderstatus") == "F", "Delivered")
        .when(F.col("o_orderstatus") == "O", "Pending")
        .otherwise("Shipped")
        .alias("order_status"),
        to_money(F.col("o_totalprice")).alias("total_value"),
        (F.col("o_custkey") * 2).alias("address_id"),
    )


def order_items(lines: DataFrame) -> DataFrame:
    quantity, price = to_money(F.col("l_quantity")), to_money(F.col("l_extendedprice"))
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        quantity.alias("quantity"),
        price.alias("price_per_unit"),
        to_money(quantity * price).alias("total_value"),
    )


def deliveries(lines: DataFrame) -> DataFrame:
    """One delivery per order, taken from its first line; open lines have no partner."""
    first = F.min_by(F.struct("l_suppkey", "l_shipdate", "l_linestatus"), "l_linenumber")
    return (
        lines.groupBy("l_orderkey")
        .agg(first.alias("line"))
        .select(
            F.col("l_orderkey").alias("delivery_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("line.l_shipdate").cast("date").alias("delivery_date"),
            F.when(F.col("line.l_linestatus") == "F", "Delivered")
            .otherwise("In Transit")
            .alias("delivery_status"),
            F.when(F.col("line.l_linestatus") == "F", F.col("line.l_suppkey").cast("string"))
            .alias("delivery_partner_id"),
            F.concat(F.lit("T"), F.col("l_orderkey")).alias("tracking_number"),
        )
    )


def returns(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("l_returnflag") == "R").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("return_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").cast("date").alias("return_date"),
        F.when(F.col("l_linestatus") == "F", "Damaged")
        .otherwise("Wrong Item")
        .alias("return_reason"),
    )


def _current(dim: DataFrame) -> DataFrame:
    return dim.withColumns(
        {
            VALID_FROM: ts(LOADED),
            VALID_TO: F.lit(None).cast("timestamp_ntz"),
            IS_CURRENT: F.lit(True),
            "last_updated_ts": ts(LOADED),
        }
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _current(
        table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            to_money(F.col("p_retailprice")).alias("price"),
            F.col("p_size").cast("bigint").alias("stock_quantity"),
        )
    )


def products_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small products were cheaper once: an earlier, closed version of each."""
    now = products(spark, sf_dir)
    earlier = now.filter(F.col("category") == "SMALL").withColumns(
        {
            "price": to_money(F.col("price") - 1),
            VALID_TO: ts(CLOSED),
            IS_CURRENT: F.lit(False),
        }
    )
    return now.unionByName(earlier)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _current(
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "Female")
            .otherwise("Male")
            .alias("gender"),
            F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"),
            F.lit("1990-01-01").cast("date").alias("dob"),
            F.concat(F.lit("0"), F.col("c_custkey")).alias("phone_number"),
            F.lit("2020-01-01").cast("date").alias("joining_date"),
        )
    )


def customer_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer's nation, and for one segment a second address by region."""
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )

    def address(number: int, city: str):
        return F.struct(
            (F.col("c_custkey") * 2 + number).alias("address_id"),
            F.col("c_custkey").alias("customer_id"),
            F.concat(F.lit("Unit "), F.col("c_custkey"), F.lit('\n"Main" Road')).alias("address"),
            F.col(city).alias("city"),
            F.col("r_name").alias("state"),
            F.col("c_nationkey").cast("string").alias("zip_code"),
            F.col("r_name").alias("country"),
        )

    both = F.array(address(0, "n_name"), address(1, "r_name"))
    one = F.array(address(0, "n_name"))
    chosen = F.when(F.col("c_mktsegment") == "BUILDING", both).otherwise(one)
    return _current(places.select(F.inline(chosen)))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _current(
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").cast("bigint").alias("location_id"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.col("r_name").alias("country"),
            F.col("n_nationkey").cast("string").alias("latitude"),
            F.col("n_regionkey").cast("string").alias("longitude"),
        )
    )


def delivery_partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _current(
        table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("delivery_partner_id"),
            F.col("s_name").alias("partner_name"),
            F.concat(F.lit("0"), F.col("s_suppkey")).alias("contact_number"),
            F.col("s_nationkey").cast("string").alias("service_area"),
        )
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("payment_date"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Credit Card")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "UPI")
        .otherwise("Cash on Delivery")
        .alias("payment_method"),
        F.when(F.col("o_orderstatus") == "F", "Completed")
        .when(F.col("o_orderstatus") == "O", "Pending")
        .otherwise("Failed")
        .alias("payment_status"),
        to_money(F.col("o_totalprice")).alias("payment_amount"),
    )


def entity_views(
    spark: SparkSession, sf_dir: str, lines: DataFrame, history: bool = False
) -> dict[str, DataFrame]:
    """Curated tables by entity name, facts from the given (latest) order lines;
    `history` adds closed product versions."""
    return {
        "customers": customers(spark, sf_dir),
        "customer_addresses": customer_addresses(spark, sf_dir),
        "locations": locations(spark, sf_dir),
        "products": (products_with_history if history else products)(spark, sf_dir),
        "delivery_partners": delivery_partners(spark, sf_dir),
        "orders": orders(spark, sf_dir),
        "order_items": order_items(lines),
        "deliveries": deliveries(lines),
        "returns": returns(lines),
        "payments": payments(spark, sf_dir),
    }


def source_columns(views: dict[str, DataFrame], name: str) -> DataFrame:
    """An entity as its files would hold it: declared columns as text."""
    return views[name].select(
        *[F.col(c).cast("string").alias(c) for c in ENTITIES[name].columns]
    )
