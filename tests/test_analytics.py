import datetime as dt
from decimal import Decimal as D

import pytest
from helpers import rows

from tiermart.plans import analytics as a

SCHEMA = (
    "order_id long, customer_id long, customer_name string, gender string, order_date date, "
    "order_status string, total_value decimal(10,2), category string, product_name string, "
    "quantity decimal(10,2), price_per_unit decimal(10,2), customer_city string, "
    "delivery_partner string, return_id long"
)


def _day(month, day=5):
    return dt.date(2024, month, day)


@pytest.fixture(scope="module")
def master(spark):
    done, open_ = "Delivered", "Pending"
    data = [
        # order 1 has two items and one return, order 2 one item, order 3 is open
        (1, 1, "A", "F", _day(1), done, D(100), "X", "p", D(1), D(10), "Delhi", None, None),
        (1, 1, "A", "F", _day(1), done, D(100), "Y", "q", D(2), D(5), "Delhi", None, 7),
        (2, 2, "B", "M", _day(3), done, D(300), "X", "p", D(3), D(10), "Pune", "P1", None),
        (3, 2, "B", "M", _day(3, 9), open_, D(50), "X", "r", D(1), D(1), "Pune", "P1", None),
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize(
    "report, expected",
    [
        (a.total_sales_revenue, [(D("550.00"),)]),
        (a.average_order_value, [(D("137.50"),)]),
        (
            a.monthly_sales_growth,
            [(1, 2024, D("200.00"), None, None), (3, 2024, D("300.00"), D("200.00"), 50.0)],
        ),
        (a.units_sold, [(D("7.00"),)]),
        (a.sales_by_category, [("X", D("41.0000")), ("Y", D("10.0000"))]),
        (a.sales_by_city, [("Delhi", D("200.00")), ("Pune", D("300.00"))]),
        (a.sales_conversion_rate, [(150.0,)]),
        (a.sales_return_rate, [(25.0,)]),
        (a.sales_by_delivery_partner, [("P1", D("300.00")), (None, D("200.00"))]),
        (a.top_selling_products, [("p", D("4.00"), D("40.0000")), ("q", D("2.00"), D("10.0000"))]),
        (a.unique_customers, [(2,)]),
        (a.average_orders_per_customer, [(2.0,)]),
        (a.top_customers, [(1, "A", D("200.00")), (2, "B", D("350.00"))]),
        (a.average_order_value_per_customer, [(1, 100.0), (2, 175.0)]),
        (a.customer_lifetime_value, [(1, D("200.00")), (2, D("350.00"))]),
        (a.peak_purchase_day, [(5, 3)]),
        (a.purchases_by_city, [("Delhi", 1, D("200.00")), ("Pune", 1, D("350.00"))]),
        (a.sales_by_gender, [("F", 1, D("200.00")), ("M", 1, D("350.00"))]),
        # order rows: customer 1 has two, customer 2 has one delivered
        (a.customer_retention_rate, [(50.0,)]),
    ],
    ids=lambda x: getattr(x, "__name__", ""),
)
def test_report(master, report, expected):
    assert rows(report(master)) == sorted(expected, key=repr)


def test_every_report_is_covered():
    assert len(a.REPORTS) == 19


def test_order_grain_variants(master):
    assert rows(a.total_sales_revenue(a.order_grain(master))) == [(D("450.00"),)]
    assert rows(a.customer_retention_rate(master, distinct_orders=True)) == [(0.0,)]
    assert rows(a.average_orders_per_customer(master, distinct_orders=True)) == [(1.5,)]


@pytest.mark.parametrize("name", list(a.REPORTS))
def test_reports_of_nothing(master, name):
    for row in a.REPORTS[name](master.filter("false")).collect():
        assert all(v is None or v == 0 for v in row)


def test_ranking_order_and_limit(spark, master):
    cities = [r.customer_city for r in a.sales_by_city(master).collect()]
    assert cities == ["Pune", "Delhi"]
    assert [r.customer_id for r in a.top_customers(master, 1).collect()] == [2]


def test_growth_from_zero_is_null(spark):
    data = [
        (1, 1, "A", "F", _day(m), "Delivered", D(v), "X", "p", D(1), D(1), "c", None, None)
        for m, v in ((1, 0), (2, 10))
    ]
    growth = a.monthly_sales_growth(spark.createDataFrame(data, SCHEMA)).collect()
    assert [r.sales_growth_percentage for r in growth] == [None, None]


def test_reports_run_as_sql_text(spark, master):
    """The wide table answers plain SQL as well."""
    master.createOrReplaceTempView("master_orders")
    row = spark.sql(
        "SELECT category, sum(quantity * price_per_unit) AS sales FROM master_orders "
        "WHERE order_status = 'Delivered' GROUP BY category ORDER BY sales DESC LIMIT 1"
    ).first()
    assert row.category == "X" and row.sales == 40


def test_events(spark):
    events = spark.createDataFrame(
        [(1, "purchase", dt.datetime(2024, 1, 1, 9)), (1, "view", dt.datetime(2024, 1, 1, 9)),
         (2, "view", dt.datetime(2024, 1, 1, 10))],
        "user_id long, event_type string, ts timestamp_ntz",
    )
    assert rows(a.purchases_by_hour(events)) == [(9, 1)]
    assert rows(a.visitor_conversion(events)) == [(2, 1, 50.0)]
