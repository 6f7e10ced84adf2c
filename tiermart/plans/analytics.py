"""Sales and customer reports on the wide orders table.

Every function takes the wide table and returns one small report. Grouped
reports aggregate before the shuffle, distinct counts are taken in two steps by
Spark, and top-k reports keep k rows per task, so a customer, city or product
with a large share of the rows does not load one task. Ties at a limit are
broken by the group key; NULL amounts sort last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermart.functions import exact_mean, growth_percentage, mean, percentage
from tiermart.operators.bitmaps import distinct_counts, distinct_state
from tiermart.operators.dedupe import dedupe_latest
from tiermart.plans.wide import DELIVERED

REPORT_SIZE = 10


def _delivered(master: DataFrame) -> DataFrame:
    return master.filter(F.col("order_status") == DELIVERED)


def _sum(column: Column | str) -> Column:
    """Sum of a two-digit amount."""
    return F.sum(column).cast("decimal(20,2)")


def _sales() -> Column:
    """Sum of the sale value of the items."""
    return F.sum(F.col("quantity") * F.col("price_per_unit")).cast("decimal(31,4)")


def ranked(report: DataFrame, amount: str, *keys: str) -> DataFrame:
    return report.orderBy(F.desc_nulls_last(amount), *[F.asc_nulls_last(k) for k in keys])


def order_grain(master: DataFrame) -> DataFrame:
    """One row per order: the order-level columns without the item fan-out.

    Where versions of the customer join, the order keeps one of them, chosen by the columns' values.
    """
    columns = master.select(
        "order_id", "customer_id", "customer_name", "gender",
        "order_date", "order_status", "total_value",
    )
    return dedupe_latest(columns, ["order_id"], ["order_date"])


# ---- sales ------------------------------------------------------------------


def total_sales_revenue(master: DataFrame) -> DataFrame:
    return master.agg(_sum("total_value").alias("total_sales_revenue"))


def average_order_value(master: DataFrame) -> DataFrame:
    value = exact_mean(F.sum("total_value"), F.count("total_value"))
    return master.agg(value.alias("average_order_value"))


def monthly_sales_growth(master: DataFrame) -> DataFrame:
    """Sales per month and their change against the previous month with sales."""
    months = (
        _delivered(master)
        .groupBy(F.month("order_date").alias("month"), F.year("order_date").alias("year"))
        .agg(_sum("total_value").alias("monthly_sales"))
    )
    return growth_by_month(months)


def growth_by_month(months: DataFrame) -> DataFrame:
    """(month, year, monthly_sales) with the month before; the window runs over one row per month."""
    by_time = Window.orderBy("year", "month")
    return (
        months.withColumn("previous_month_sales", F.lag("monthly_sales").over(by_time))
        .withColumn(
            "sales_growth_percentage",
            growth_percentage(F.col("monthly_sales"), F.col("previous_month_sales")),
        )
        .orderBy("year", "month")
    )


def units_sold(master: DataFrame) -> DataFrame:
    return master.agg(_sum("quantity").alias("total_units_sold"))


def sales_by_category(master: DataFrame) -> DataFrame:
    report = master.groupBy(F.col("category").alias("product_category")).agg(
        _sales().alias("total_sales_by_category")
    )
    return ranked(report, "total_sales_by_category", "product_category")


def sales_by_city(master: DataFrame) -> DataFrame:
    report = (
        _delivered(master)
        .groupBy("customer_city")
        .agg(_sum("total_value").alias("total_sales_by_city"))
    )
    return ranked(report, "total_sales_by_city", "customer_city")


def sales_conversion_rate(master: DataFrame) -> DataFrame:
    """Distinct orders per distinct customer, in percent."""
    rate = percentage(F.count_distinct("order_id"), F.count_distinct("customer_id"))
    return master.agg(rate.alias("sales_conversion_rate"))


def sales_return_rate(master: DataFrame) -> DataFrame:
    """Share of item rows with a return, in percent."""
    rate = percentage(F.count("return_id"), F.count("order_id"))
    return master.agg(rate.alias("sales_return_rate"))


def sales_by_delivery_partner(master: DataFrame) -> DataFrame:
    """Orders without a known partner form the NULL group."""
    report = (
        _delivered(master)
        .groupBy("delivery_partner")
        .agg(_sum("total_value").alias("total_sales_by_partner"))
    )
    return ranked(report, "total_sales_by_partner", "delivery_partner")


def top_selling_products(master: DataFrame, n: int = REPORT_SIZE) -> DataFrame:
    report = (
        _delivered(master)
        .groupBy("product_name")
        .agg(_sum("quantity").alias("total_units_sold"), _sales().alias("total_sales"))
    )
    return ranked(report, "total_sales", "product_name").limit(n)


# ---- customers --------------------------------------------------------------


def unique_customers(master: DataFrame) -> DataFrame:
    return _delivered(master).agg(
        F.count_distinct("customer_id").alias("total_unique_customers")
    )


def _orders_per_customer(master: DataFrame, distinct_orders: bool) -> DataFrame:
    count = F.count_distinct if distinct_orders else F.count
    return master.groupBy("customer_id").agg(count("order_id").alias("order_count"))


def average_orders_per_customer(master: DataFrame, distinct_orders: bool = False) -> DataFrame:
    """Mean over customers of their order rows, or of their orders."""
    value = mean(F.sum("order_count"), F.count("order_count"))
    return _orders_per_customer(master, distinct_orders).agg(value.alias("avg_order_frequency_per_customer"))


def top_customers(master: DataFrame, n: int = REPORT_SIZE) -> DataFrame:
    report = master.groupBy("customer_id", "customer_name").agg(
        _sum("total_value").alias("total_spending")
    )
    return ranked(report, "total_spending", "customer_id", "customer_name").limit(n)


def average_order_value_per_customer(master: DataFrame) -> DataFrame:
    value = mean(F.sum("total_value"), F.count("total_value"))
    return master.groupBy("customer_id").agg(value.alias("avg_order_value"))


def customer_lifetime_value(master: DataFrame) -> DataFrame:
    return master.groupBy("customer_id").agg(
        _sum("total_value").alias("customer_lifetime_value")
    )


def peak_purchase_day(master: DataFrame) -> DataFrame:
    """Day of the month with most order rows."""
    report = master.groupBy(F.dayofmonth("order_date").alias("daily_order")).agg(
        F.count("order_id").alias("orders_count")
    )
    return ranked(report, "orders_count", "daily_order").limit(1)


def _customers_and_sales(master: DataFrame, key: str) -> DataFrame:
    report = master.groupBy(key).agg(
        F.count_distinct("customer_id").alias("unique_customers"),
        _sum("total_value").alias("total_sales"),
    )
    return ranked(report, "total_sales", key)


def purchases_by_city(master: DataFrame) -> DataFrame:
    return _customers_and_sales(master, "customer_city")


def sales_by_gender(master: DataFrame) -> DataFrame:
    return _customers_and_sales(master, "gender")


def customer_retention_rate(master: DataFrame, distinct_orders: bool = False) -> DataFrame:
    """Share of customers with more than one order row (or order), in percent.

    The input of the last step has one row per customer, so its row count is
    the number of distinct customers.
    """
    repeat = F.sum(F.when(F.col("order_count") > 1, 1).otherwise(0))
    rate = percentage(repeat, F.count("customer_id"))
    return _orders_per_customer(_delivered(master), distinct_orders).agg(
        rate.alias("customer_retention_rate")
    )


# ---- the same by bitmaps ----------------------------------------------------


def unique_customers_by_bitmap(master: DataFrame) -> DataFrame:
    state = distinct_state(_delivered(master), [], "customer_id")
    return distinct_counts(state, [], "total_unique_customers")


def customers_and_sales_by_bitmap(master: DataFrame, key: str) -> DataFrame:
    state = distinct_state(master, [key], "customer_id", {"total_sales": F.col("total_value")})
    report = distinct_counts(state, [key], "unique_customers", ["total_sales"])
    report = report.withColumn("total_sales", F.col("total_sales").cast("decimal(20,2)"))
    return ranked(report, "total_sales", key)


def sales_conversion_rate_by_bitmap(master: DataFrame) -> DataFrame:
    orders, customers = (
        distinct_counts(distinct_state(master, [], c), [], c).select(F.lit(c).alias("of"), F.col(c).alias("n"))
        for c in ("order_id", "customer_id")
    )
    number = [F.sum(F.when(F.col("of") == c, F.col("n"))) for c in ("order_id", "customer_id")]
    return orders.union(customers).agg(percentage(*number).alias("sales_conversion_rate"))


# ---- beyond the wide table --------------------------------------------------


def purchases_by_hour(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Purchases per hour of the day, from timestamped events."""
    return (
        events.filter(F.col("event_type") == "purchase")
        .groupBy(F.hour(ts).alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("purchases"))
    )


def visitor_conversion(events: DataFrame, visitor: str = "user_id") -> DataFrame:
    """Visitors, visitors who purchased and their share, one row.

    Events are first reduced to one row per visitor, combined on the map side.
    """
    per_visitor = events.groupBy(visitor).agg(
        F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("bought")
    )
    return per_visitor.agg(
        F.count(visitor).alias("visitors"),
        F.sum("bought").cast("bigint").alias("buyers"),
        percentage(F.sum("bought"), F.count(visitor)).alias("conversion_rate"),
    )


def payments_by_method(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_method", "payment_status").agg(
        F.count(F.lit(1)).alias("payments"), _sum("payment_amount").alias("total_amount")
    )


SALES_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "sales_total_revenue": total_sales_revenue,
    "sales_average_order_value": average_order_value,
    "sales_monthly_growth": monthly_sales_growth,
    "sales_units_sold": units_sold,
    "sales_by_category": sales_by_category,
    "sales_by_city": sales_by_city,
    "sales_conversion_rate": sales_conversion_rate,
    "sales_return_rate": sales_return_rate,
    "sales_by_delivery_partner": sales_by_delivery_partner,
    "sales_top_products": top_selling_products,
}
CUSTOMER_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "cust_unique": unique_customers,
    "cust_avg_orders": average_orders_per_customer,
    "cust_top_spenders": top_customers,
    "cust_avg_order_value": average_order_value_per_customer,
    "cust_lifetime_value": customer_lifetime_value,
    "cust_peak_purchase_day": peak_purchase_day,
    "cust_by_city": purchases_by_city,
    "cust_by_gender": sales_by_gender,
    "cust_retention_rate": customer_retention_rate,
}
REPORTS = {**SALES_REPORTS, **CUSTOMER_REPORTS}
