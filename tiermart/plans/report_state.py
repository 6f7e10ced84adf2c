"""The reports from sums that are kept per load and added up when they are read.

A load takes the rows that it removed from the wide table and those that it added, and stores one small state: per
group of a facet (customers, products, days, partners) sums and counts, those of removed rows negative. Whole
orders are removed and added, so the number of different orders can be added up as well, and customers
are counted by the groups that still have rows. No report reads the wide table again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.functions import exact_mean, mean, percentage
from tiermart.plans.analytics import REPORT_SIZE, growth_by_month, ranked
from tiermart.plans.wide import DELIVERED
from tiermart.sources.tables import CURATED, Layers

TABLE, LOAD = "report_state", "load"
MOST_LOADS = 32  # states that are added up when read; one more folds them into one
ADDED, REMOVED = 1, -1

FACETS = {
    "customer": ["customer_id", "customer_name", "customer_city", "gender"],
    "product": ["product_name", "category"],
    "day": ["order_day"],
    "partner": ["delivery_partner"],
}
KEYS = [key for keys in FACETS.values() for key in keys]
AMOUNTS = ["value", "units", "sales"]
COUNTS = ["row", "order_row", "return"]
_SIGN, _TOTAL = "__sign", "decimal(31,4)"
MEASURES = [
    f"{prefix}{name}"
    for prefix in ("", "delivered_")
    for name in [*(f"{c}s" for c in COUNTS), *AMOUNTS, *(f"{a}_n" for a in AMOUNTS)]
]


# ---- states ----


def state_of(added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """(facet, KEYS, MEASURES) of rows of the wide table that a load added and removed.

    An order whose rows change must be removed whole, as it was, and added whole, as it is. Groups are built in one pass
    and combined before the shuffle; the number of different orders stands in the facet `orders`.
    """
    rows = added.withColumn(_SIGN, F.lit(ADDED))
    if removed is not None:
        rows = rows.unionByName(removed.withColumn(_SIGN, F.lit(REMOVED)))
    delivered = F.coalesce(F.col("order_status") == DELIVERED, F.lit(False))
    facts = rows.select(
        _SIGN,
        *[F.col(key) for key in KEYS if key != "order_day"],
        F.to_date("order_date").alias("order_day"),
        delivered.alias("__delivered"),
        F.lit(1).alias("row"),
        F.col("order_id").alias("order_row"),
        F.col("return_id").alias("return"),
        F.col("total_value").alias("value"),
        F.col("quantity").alias("units"),
        (F.col("quantity") * F.col("price_per_unit")).alias("sales"),
    )
    measures = []
    for prefix, counted in (("", F.lit(True)), ("delivered_", F.col("__delivered"))):

        def number(column: str, counted: Column = counted) -> Column:
            held = F.when(counted & F.col(column).isNotNull(), F.col(_SIGN))
            return F.coalesce(F.sum(held), F.lit(0)).cast("bigint")

        def total(column: str, counted: Column = counted) -> Column:
            signed = F.when(F.col(_SIGN) == REMOVED, -F.col(column)).otherwise(F.col(column))
            return F.coalesce(F.sum(F.when(counted, signed)), F.lit(0)).cast(_TOTAL)

        measures += [number(c).alias(f"{prefix}{c}s") for c in COUNTS]
        measures += [total(a).alias(f"{prefix}{a}") for a in AMOUNTS]
        measures += [number(a).alias(f"{prefix}{a}_n") for a in AMOUNTS]
    facet = reduce(
        lambda chosen, name: chosen.when(F.grouping(FACETS[name][0]) == 0, name), FACETS, F
    )
    groups = facts.groupingSets(list(FACETS.values()), *KEYS).agg(facet.alias("facet"), *measures)
    number_of_orders = (
        rows.filter("order_id IS NOT NULL")
        .groupBy("order_id", _SIGN)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(_SIGN), F.lit(0)).cast("bigint").alias("rows"))
        .withColumn("facet", F.lit("orders"))
    )
    columns = ["facet", *KEYS, *MEASURES]
    return groups.select(*columns).unionByName(number_of_orders, allowMissingColumns=True).select(*columns)


def merged(states: Sequence[DataFrame]) -> DataFrame:
    """One state of several; groups whose rows were all removed are gone."""
    every = reduce(DataFrame.unionByName, states)
    sums = [F.sum(m).cast(every.schema[m].dataType).alias(m) for m in MEASURES]
    return every.groupBy("facet", *KEYS).agg(*sums).filter("rows <> 0")


class ReportState:
    """States of the loads of a wide table, in a table partitioned by load.

    Which loads count is written beside the wide table's buckets, in the statement that publishes them; what a failed
    load has stored is in no report.
    """

    def __init__(self, layers: Layers) -> None:
        self.layers = layers

    @property
    def name(self) -> str:
        return self.layers.name(CURATED, TABLE)

    def of(self, loads: Sequence[int]) -> DataFrame:
        """The states of these loads; only their partitions are read."""
        return self.layers.table(CURATED, TABLE).where(F.col(LOAD).isin(list(loads))).drop(LOAD)

    def add(self, load: int, loads: Sequence[int], state: DataFrame) -> list[int]:
        """Store the state of a load; the loads that count with it."""
        counted = [*loads, load]
        if len(counted) > MOST_LOADS:
            state, counted = merged([self.of(loads), state]), [load]
        state = state.withColumn(LOAD, F.lit(load).cast("bigint"))
        self.layers.create_table(CURATED, TABLE, state.schema, partition_by=[LOAD])
        state.write.mode("append").insertInto(self.name)
        return counted

    def forget(self, loads: Sequence[int]) -> None:
        """Drop the states of loads that no published table names."""
        for load in loads:
            self.layers.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({LOAD} = {load})")


# ---- reports ----


def _facet(state: DataFrame, name: str, delivered: bool = False) -> DataFrame:
    found = state.filter(F.col("facet") == name)
    return found.filter("delivered_rows > 0") if delivered else found


def _sum(amount: str, kind: str = "decimal(20,2)") -> Column:
    """The sum of an amount, null where no row has one."""
    return F.when(F.sum(f"{amount}_n") > 0, F.sum(amount)).cast(kind)


def _of_all(state: DataFrame, alias: str, value: Column) -> DataFrame:
    return _facet(state, "partner").agg(value.alias(alias))


def _by(state: DataFrame, facet: str, key: Column, amount: Column, alias: str, delivered: bool = True) -> DataFrame:
    return _facet(state, facet, delivered).groupBy(key).agg(amount.alias(alias))


def _monthly_growth(state: DataFrame) -> DataFrame:
    months = _facet(state, "day", delivered=True).groupBy(
        F.month("order_day").alias("month"), F.year("order_day").alias("year")
    )
    return growth_by_month(months.agg(_sum("delivered_value").alias("monthly_sales")))


def _conversion_rate(state: DataFrame) -> DataFrame:
    customers = state.filter("facet IN ('customer', 'orders')").groupBy("facet", "customer_id")
    orders = F.sum(F.when(F.col("facet") == "orders", F.col("rows")))
    rate = percentage(F.coalesce(orders, F.lit(0)), F.count("customer_id"))
    return customers.agg(F.sum("rows").alias("rows")).agg(rate.alias("sales_conversion_rate"))


def _top_products(state: DataFrame) -> DataFrame:
    report = _facet(state, "product", delivered=True).groupBy("product_name").agg(
        _sum("delivered_units").alias("total_units_sold"), _sum("delivered_sales", _TOTAL).alias("total_sales")
    )
    return ranked(report, "total_sales", "product_name").limit(REPORT_SIZE)


def _top_customers(state: DataFrame) -> DataFrame:
    report = _facet(state, "customer").groupBy("customer_id", "customer_name").agg(_sum("value").alias("total_spending"))
    return ranked(report, "total_spending", "customer_id", "customer_name").limit(REPORT_SIZE)


def _customers_and_sales(state: DataFrame, key: str) -> DataFrame:
    report = _facet(state, "customer").groupBy(key).agg(
        F.count_distinct("customer_id").alias("unique_customers"), _sum("value").alias("total_sales")
    )
    return ranked(report, "total_sales", key)


def _peak_day(state: DataFrame) -> DataFrame:
    day = F.dayofmonth("order_day").alias("daily_order")
    report = _by(state, "day", day, F.sum("order_rows"), "orders_count", delivered=False)
    return ranked(report, "orders_count", "daily_order").limit(1)


def _retention(state: DataFrame) -> DataFrame:
    id_ = F.col("customer_id")
    counts = _by(state, "customer", id_, F.sum("delivered_order_rows"), "order_count")
    repeat = F.sum(F.when(F.col("order_count") > 1, 1).otherwise(0))
    return counts.agg(percentage(repeat, F.count("customer_id")).alias("customer_retention_rate"))


def _average_orders(state: DataFrame) -> DataFrame:
    counts = _by(state, "customer", F.col("customer_id"), F.sum("order_rows"), "order_count", delivered=False)
    value = mean(F.sum("order_count"), F.count("order_count"))
    return counts.agg(value.alias("avg_order_frequency_per_customer"))


def _ranked_by(facet: str, key: str, amount: Column, alias: str, name: str, delivered: bool = True):
    return lambda state: ranked(
        _by(state, facet, F.col(key).alias(name), amount, alias, delivered), alias, name
    )


def _per_customer(amount: Callable[[], Column], alias: str):
    return lambda state: _by(state, "customer", F.col("customer_id"), amount(), alias, delivered=False)


def state_reports() -> Mapping[str, Callable[[DataFrame], DataFrame]]:
    """The 19 reports by name, each a function of the merged state."""
    return {
        "sales_total_revenue": lambda s: _of_all(s, "total_sales_revenue", _sum("value")),
        "sales_average_order_value": lambda s: _of_all(
            s, "average_order_value", exact_mean(F.sum("value"), F.sum("value_n"))
        ),
        "sales_monthly_growth": _monthly_growth,
        "sales_units_sold": lambda s: _of_all(s, "total_units_sold", _sum("units")),
        "sales_by_category": _ranked_by(
            "product", "category", _sum("sales", _TOTAL), "total_sales_by_category", "product_category", False
        ),
        "sales_by_city": _ranked_by(
            "customer", "customer_city", _sum("delivered_value"), "total_sales_by_city", "customer_city"
        ),
        "sales_conversion_rate": _conversion_rate,
        "sales_return_rate": lambda s: _of_all(
            s, "sales_return_rate", percentage(F.sum("returns"), F.sum("order_rows"))
        ),
        "sales_by_delivery_partner": _ranked_by(
            "partner", "delivery_partner", _sum("delivered_value"), "total_sales_by_partner", "delivery_partner"
        ),
        "sales_top_products": _top_products,
        "cust_unique": lambda s: _facet(s, "customer", delivered=True).agg(
            F.count_distinct("customer_id").alias("total_unique_customers")
        ),
        "cust_avg_orders": _average_orders,
        "cust_top_spenders": _top_customers,
        "cust_avg_order_value": _per_customer(lambda: mean(F.sum("value"), F.sum("value_n")), "avg_order_value"),
        "cust_lifetime_value": _per_customer(lambda: _sum("value"), "customer_lifetime_value"),
        "cust_peak_purchase_day": _peak_day,
        "cust_by_city": lambda s: _customers_and_sales(s, "customer_city"),
        "cust_by_gender": lambda s: _customers_and_sales(s, "gender"),
        "cust_retention_rate": _retention,
    }
