"""What the plans have to look like, and how they treat hot keys."""

import re
import uuid

import pytest
from helpers import T, final_plan, plan, rows
from pyspark.sql import functions as F

from tiermart.operators.dedupe import dedupe_latest
from tiermart.operators.merge import new_rows, scd1_upsert, scd2_apply
from tiermart.operators.lookup import as_of
from tiermart.operators.quality import check_unique
from tiermart.operators.skew import CELL, divide_by, divided_join, find_cells
from tiermart.plans import analytics
from tiermart.plans.wide import MASTER_COLUMNS, build_master_orders
from tiermart.session import materialise, scratch_path
from tiermart.sources.tables import CLEAN, Layers

N = 30_000


def _shuffles(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture
def no_broadcast(conf):
    conf(autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1)


@pytest.fixture
def small_skew(conf, no_broadcast):
    """Thresholds scaled down, so that these small tables count as skewed."""
    conf(
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        adaptive__skewJoin__skewedPartitionFactor=2,
        adaptive__advisoryPartitionSizeInBytes="8KB",
    )


def _hot(column, value):
    """A third of all rows get one value."""
    return F.when(F.col("id") % 3 == 0, F.lit(value)).otherwise(column)


@pytest.fixture(scope="module")
def tables(spark):
    """One order, one product, one customer and no partner hold a third of the rows."""
    ids = spark.range(0, N, 1, 8)
    money = F.lit("10.50").cast("decimal(10,2)")
    day = F.lit("2024-01-05").cast("date")
    text = F.col("id").cast("string")
    dim = [F.lit(True).alias("is_current")]
    made = {
        "orders": ids.select(
            F.col("id").alias("order_id"),
            _hot(F.col("id"), 1).alias("customer_id"),
            day.alias("order_date"),
            F.when(F.col("id") < N - 100, "Delivered").otherwise("Pending").alias("order_status"),
            money.alias("total_value"),
            _hot(F.col("id"), 1).alias("address_id"),
        ),
        "order_items": ids.select(
            F.col("id").alias("order_item_id"),
            _hot(F.col("id"), 4).alias("order_id"),
            _hot(F.col("id"), 2).alias("product_id"),
            money.alias("quantity"),
            money.alias("price_per_unit"),
        ),
        "deliveries": ids.select(
            F.col("id").alias("delivery_id"),
            F.col("id").alias("order_id"),
            day.alias("delivery_date"),
            text.alias("delivery_status"),
            F.when(F.col("id") % 3 != 0, text).alias("delivery_partner_id"),
        ),
        "returns": ids.filter("id % 3 = 1").select(
            F.col("id").alias("return_id"),
            F.col("id").alias("order_id"),
            F.col("id").alias("product_id"),
            day.alias("return_date"),
            text.alias("return_reason"),
        ),
        "products": ids.select(
            F.col("id").alias("product_id"),
            text.alias("product_name"),
            text.alias("category"),
            money.alias("price"),
            F.col("id").alias("stock_quantity"),
            *dim,
        ),
        "customers": ids.select(
            F.col("id").alias("customer_id"),
            text.alias("name"),
            text.alias("gender"),
            day.alias("dob"),
            text.alias("phone_number"),
            day.alias("joining_date"),
            *dim,
        ),
        "customer_addresses": ids.select(
            F.col("id").alias("address_id"),
            F.col("id").alias("customer_id"),
            text.alias("city"),
            text.alias("state"),
            text.alias("country"),
            *dim,
        ),
        "delivery_partners": ids.select(
            F.col("id").alias("delivery_partner_id"),
            text.alias("partner_name"),
            text.alias("contact_number"),
            *dim,
        ),
    }
    return {name: materialise(df, name) for name, df in made.items()}


def test_wide_table_divides_hot_keys_and_keeps_every_row(spark, tables, no_broadcast):
    master = build_master_orders(tables, T[0])
    text = plan(master, "simple")
    for key in ("order_id", "customer_id", "partner_key", "product_id"):
        assert re.search(rf"hashpartitioning\({key}#\d+L?, __cell#", text), key
    plain = build_master_orders(tables, T[0], split_hot_keys=False)
    assert "__cell" not in plan(plain, "simple")
    assert master.count() == plain.count() == 10_000 + 2 * 10_000 - 100 + 33
    assert master.exceptAll(plain).isEmpty() and plain.exceptAll(master).isEmpty()


def test_no_task_gets_a_hot_key_whole(spark, tables):
    items, returns = tables["order_items"], tables["returns"]
    cells = find_cells({"j": [(items, ["order_id"]), (returns, ["order_id"])]})["j"]
    placed = cells.place(items, ["order_id"], {0: ["order_item_id"], 1: ["product_id"]})
    assert placed.count() == N
    largest = placed.groupBy("order_id", CELL).count().agg(F.max("count")).first()[0]
    # four shuffle partitions: a third of the rows over three cells
    assert largest < N / 3 / 3 * 1.1


@pytest.mark.parametrize("products, repeats", [(1000, False), (1, True)])
def test_rows_that_differ_need_no_repeated_partners(spark, products, repeats):
    """An order with a third of all items and a third of all returns."""
    items = spark.range(0, 9000, 1, 4).select(
        _hot(F.col("id"), -1).alias("order_id"), (F.col("id") % products).alias("product_id"), "id"
    )
    returns = items.filter("id % 9 < 4").select("order_id", "product_id", F.col("id").alias("r"))
    key = ["order_id"]
    cells = find_cells({"j": [(items, key), (returns, key)]})["j"]
    cells = divide_by(cells, items, key, ["product_id"], first=1, then=0)
    placed = cells.place(items, key, {0: ["id"], 1: ["product_id"]})
    partners = cells.place(returns, key, {1: ["product_id"]})
    assert placed.count() == 9000
    assert (partners.count() > returns.count()) == repeats
    largest = placed.groupBy("order_id", CELL).count().agg(F.max("count")).first()[0]
    assert largest < 2000
    if products > 1:
        joined = placed.join(partners, [*cells.on(key), "product_id"], "left").drop(CELL)
        plain = items.join(returns, ["order_id", "product_id"], "left")
        columns = ["order_id", "product_id", "id", "r"]
        assert rows(joined.select(*columns)) == rows(plain.select(*columns))


def test_hot_keys_on_both_sides_meet_once(spark):
    left = spark.range(0, 600, 1, 4).select(_hot(F.col("id"), -1).alias("k"), F.col("id").alias("a"))
    right = spark.range(0, 300, 1, 4).select(_hot(F.col("id"), -1).alias("k"), F.col("id").alias("b"))
    cells = find_cells({"j": [(left, ["k"]), (right, ["k"])]})["j"]
    assert cells.table.count() == 1
    joined = cells.place(left, ["k"], {0: ["a"]}).join(
        cells.place(right, ["k"], {1: ["b"]}), cells.on(["k"])
    )
    assert rows(joined.select("k", "a", "b")) == rows(left.join(right, "k"))


def test_hot_null_keys_of_an_outer_join(spark):
    left = spark.range(0, 900, 1, 4).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), F.col("id").alias("a")
    )
    right = spark.range(0, 500).select(F.col("id").alias("k"), F.col("id").alias("b"))
    cells = find_cells({"j": [(left, ["k"])]})["j"]
    joined = cells.place(left, ["k"], {0: ["a"]}).join(
        cells.place(right, ["k"], {}), cells.on(["k"]), "left"
    )
    assert rows(joined.select("k", "a", "b")) == rows(left.join(right, "k", "left"))


def test_small_tables_are_not_looked_at(spark, monkeypatch):
    monkeypatch.setattr("tiermart.operators.skew.SMALLEST_TABLE", 1 << 30)
    df = spark.range(0, 1000).select(F.lit(1).alias("k"))
    monkeypatch.setattr("tiermart.operators.skew.hot_keys", None)  # would be called
    assert find_cells({"j": [(df, ["k"])]})["j"].table is None


def test_hot_keys_beside_a_map_and_with_unfit_keys(spark, no_broadcast):
    left = spark.range(0, 3000).select(
        F.lit(1).alias("k"), F.create_map(F.lit("a"), "id").alias("m"), "id"
    )
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    joined = divided_join(left, right, ["k"], "left")
    assert joined.count() == 3000 and joined.select("v").distinct().count() == 1
    with pytest.raises(ValueError):
        divided_join(left, left.select("m"), ["m"], "left_semi")


def test_cells_need_equal_key_types(spark):
    left = spark.range(0, 100).select(F.lit(1).cast("bigint").alias("k"))
    cells = find_cells({"j": [(left, ["k"])]})["j"]
    with pytest.raises(ValueError, match="type"):
        cells.place(spark.range(3).select(F.col("id").cast("int").alias("k")), ["k"], {})


def test_wide_table_shuffles_each_fact_once_by_order(spark, tables, no_broadcast):
    text = plan(build_master_orders(tables, T[0], split_hot_keys=False), "simple")
    by_order = re.findall(r"Exchange hashpartitioning\(order_id#\d+L?, ", text)
    # items, placed orders, deliveries, returns; never (order_id, product_id)
    assert len(by_order) == 4
    assert not re.search(r"hashpartitioning\(order_id#\d+L?, product_id", text)
    assert _shuffles(text) == 4 + 3 + 2 + 2
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_wide_table_filter_and_columns_reach_the_scan(spark, tables):
    text = plan(build_master_orders(tables, T[0], split_hot_keys=False))
    assert "EqualTo(order_status,Delivered)" in text
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", text)
    assert not any("order_item_id" in s or "delivery_id" in s for s in schemas)


def test_small_dimensions_are_broadcast_by_their_size(spark, tables):
    text = plan(build_master_orders(tables, T[0]), "simple")
    assert "BroadcastHashJoin" in text


@pytest.mark.parametrize("name", list(analytics.REPORTS))
def test_reports_read_only_their_columns(spark, tables, name):
    master = materialise(build_master_orders(tables, T[0]), "master")
    text = plan(analytics.REPORTS[name](master))
    schema = re.search(r"ReadSchema: struct<(.*?)>\n", text).group(1)
    assert 1 <= len(re.findall(r"\w+:", schema)) <= 4
    assert len(MASTER_COLUMNS) == 30
    assert "partial_" in text and "SortAggregate" not in text


def test_top_k_keeps_k_rows_per_task(spark, tables):
    master = build_master_orders(tables, T[0])
    assert "TakeOrderedAndProject" in plan(analytics.top_customers(master), "simple")


def test_dedupe_cuts_hot_keys_before_the_shuffle(spark):
    df = spark.range(0, N, 1, 8).select(_hot(F.col("id"), 0).alias("k"), F.col("id").alias("t"))
    latest = dedupe_latest(df, ["k"], ["t"])
    text = plan(latest, "simple")
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert latest.count() == 20_001


def test_duplicate_count_combines_before_the_shuffle(spark):
    df = spark.range(0, N, 1, 8).select(_hot(F.col("id"), 0).alias("k"))
    text = plan(check_unique(df, ["k"]), "simple")
    assert text.index("Exchange") < text.index("partial_count")


def _clean(spark, rows_=N):
    return materialise(
        spark.range(0, rows_, 1, 8).select(
            F.col("id").alias("k"),
            F.col("id").cast("string").alias("v"),
            F.lit(T[0]).cast("timestamp_ntz").alias("last_updated_ts"),
        ),
        "clean",
    )


def _source(spark, start, end):
    return materialise(
        spark.range(start, end, 1, 8).select(F.col("id").alias("k"), F.lit("new").alias("v")),
        "source",
    )


def test_whole_upsert_shuffles_each_side_once(spark, no_broadcast):
    merged = scd1_upsert(
        _clean(spark), _source(spark, 10, N + 10), ["k"], run_ts=T[1], source_unique=True
    )
    assert _shuffles(plan(merged, "simple")) == 2
    assert merged.count() == N + 10


def test_lookup_upsert_leaves_the_target_in_place(spark):
    merged = scd1_upsert(
        _clean(spark),
        _source(spark, N - 5, N + 5),
        ["k"],
        run_ts=T[1],
        source_unique=True,
        incremental=True,
    )
    assert _shuffles(plan(merged, "simple")) == 0
    assert merged.count() == N + 5


def test_incremental_fact_load_leaves_the_target_in_place(spark):
    source = _source(spark, N - 5, N + 5).withColumn("last_updated_ts", F.lit(None).cast("timestamp_ntz"))
    fresh = new_rows(_clean(spark), source, ["k"], T[1], source_unique=True, incremental=True)
    assert _shuffles(plan(fresh, "simple")) == 0
    assert fresh.count() == 5


def test_guarded_upsert_divides_a_hot_target_key(spark, no_broadcast):
    target = materialise(
        _clean(spark).withColumn("k", F.when(F.col("k") % 3 == 0, F.lit(3)).otherwise(F.col("k"))),
        "hot",
    )
    merged = scd1_upsert(target, _source(spark, 0, 10), ["k"], run_ts=T[1])
    assert re.search(r"hashpartitioning\(k#\d+L?, __cell#", plan(merged, "simple"))
    assert merged.filter("k = 3 and v = 'new'").count() == N // 3
    assert merged.count() == N + 3


def test_guarded_upsert_divides_a_hot_new_key(spark, no_broadcast):
    source = materialise(
        _source(spark, N, 2 * N).withColumn(
            "k", F.when(F.col("k") % 3 == 0, F.lit(-1)).otherwise(F.col("k"))
        ),
        "hot",
    )
    merged = scd1_upsert(_clean(spark), source, ["k"], run_ts=T[1])
    assert "__cell" in plan(merged, "simple")
    assert merged.count() == 2 * N and merged.filter("k = -1").count() == N // 3


def test_point_in_time_lookup_divides_a_hot_key(spark, no_broadcast):
    facts = spark.range(0, N, 1, 8).select(
        _hot(F.col("id"), 1).alias("k"), F.lit(T[3]).cast("timestamp_ntz").alias("at"), "id"
    )
    dim = spark.range(0, N, 1, 8).select(
        F.col("id").alias("k"),
        F.lit(T[0]).cast("timestamp_ntz").alias("effective_start_date"),
        F.lit(None).cast("timestamp_ntz").alias("effective_end_date"),
        F.col("id").alias("v"),
    )
    found = as_of(facts, dim, ["k"], "at", ["v"])
    assert "__cell" in plan(found, "simple")
    assert found.filter("v = k").count() == found.count() == N


def test_run_time_split_of_a_plain_join(spark, small_skew):
    left = materialise(spark.range(0, N, 1, 8).select(_hot(F.col("id"), 1).alias("k"), "id"), "l")
    right = materialise(spark.range(0, N, 1, 8).select(F.col("id").alias("k")), "r")
    joined = left.join(right, "k", "left")
    assert "skew=true" in final_plan(joined)
    assert joined.count() == N


def test_history_takes_no_part_in_the_join(spark, no_broadcast):
    dim = materialise(
        _clean(spark).select(
            "k",
            "v",
            F.col("last_updated_ts").alias("effective_start_date"),
            F.lit(None).cast("timestamp_ntz").alias("effective_end_date"),
            (F.col("k") % 2 == 0).alias("is_current"),
            "last_updated_ts",
        ),
        "dim",
    )
    source = _source(spark, 0, N).withColumn("last_updated_ts", F.lit(T[1]).cast("timestamp_ntz"))
    text = plan(scd2_apply(dim, source, ["k"], ["v"], T[2], source_unique=True))
    assert len(re.findall(r"PushedFilters: \[.*is_current.*\]", text)) == 2
    assert _shuffles(plan(scd2_apply(dim, source, ["k"], ["v"], T[2], source_unique=True), "simple")) == 2


def test_bucketed_target_is_not_shuffled(spark, no_broadcast):
    name = f"b{uuid.uuid4().hex}_"
    layers = Layers(spark, name, scratch_path(spark, "layers"))
    layers.create()
    layers.replace(CLEAN, "t", _clean(spark), bucket_by=["k"], buckets=4)
    target = layers.table(CLEAN, "t")
    merged = scd1_upsert(target, _source(spark, 0, N + 3), ["k"], run_ts=T[1], source_unique=True)
    assert _shuffles(plan(merged, "simple")) == 1
    layers.replace(CLEAN, "t", merged, bucket_by=["k"], buckets=4)
    assert layers.table(CLEAN, "t").count() == N + 3
    layers.drop_all()
