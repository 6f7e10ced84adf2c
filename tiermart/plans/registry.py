"""Named queries over the benchmark tables, one per operator or report.

Every query reads whole tables. Reports run on the wide table, which is built
once per session and data folder and written to the shared working folder, the
way the warehouse keeps it.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermart.functions import convert_timezone
from tiermart.operators.conform import conform_entity, conform_or_quarantine
from tiermart.operators.dedupe import dedupe_latest
from tiermart.operators.lookup import as_of, as_of_sweep
from tiermart.operators.merge import (
    ambiguous_keys,
    append_rows,
    merge_insert_only,
    scd1_upsert,
    scd2_apply,
    scd2_pass,
)
from tiermart.operators.quality import (
    assign_surrogate_key,
    check_entity,
    check_foreign_key,
    check_not_null,
    check_unique,
    orphan_rows,
)
from tiermart.plans import analytics
from tiermart.plans import retail_views as views
from tiermart.plans.checks import EntityChecks, KeyCounts
from tiermart.plans.loads import (
    LoadOptions,
    load_clean,
    load_curated,
    load_raw,
    run_all,
    run_entity,
)
from tiermart.plans.refresh import MASTER, refresh_master_orders
from tiermart.plans.report_state import merged, state_of, state_reports
from tiermart.plans.wide import DIMENSIONS, FACTS, build_master_orders
from tiermart.schemas import ENTITIES, struct
from tiermart.session import configure, materialise, scratch_path
from tiermart.sources.csv import (
    read_or_quarantine,
    read_raw,
    scan_quoted,
    scan_csv,
    scan_typed,
    write_csv,
)
from tiermart.sources.files import content_keys, list_files
from tiermart.sources.landing import Landing
from tiermart.sources.tables import CLEAN, CURATED, RAW, Layers
from tiermart.streaming.ingest import ingest_available, raw_stream, upsert_available

Query = Callable[[SparkSession, str], DataFrame]

# Times of three loads. Orders up to the first time make the first load; the rest
# is one second load, or is divided again at the second time.
LOADS = ["1997-04-01 00:00:00", "1999-06-01 00:00:00", "2001-08-01 00:00:00"]

# ---- the wide table ---------------------------------------------------------

_STORED: dict[tuple[str, str, str], DataFrame] = {}


def _stored(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """A table kept for all queries of a session on one data folder."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)
    if key not in _STORED:
        _STORED[key] = materialise(build(), name)
    return _STORED[key]


def _entities(spark: SparkSession, sf_dir: str, history: bool = False) -> dict[str, DataFrame]:
    """Curated tables; the de-duplicated order lines under the facts are stored, and
    so are the deliveries that are aggregated from them."""
    lines = _stored(spark, sf_dir, "lines", lambda: views.latest_lines(spark, sf_dir))
    tables = views.entity_views(spark, sf_dir, lines, history)
    deliveries = tables["deliveries"]
    return {**tables, "deliveries": _stored(spark, sf_dir, "deliveries", lambda: deliveries)}


def master_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored wide table of a data folder, built at first use."""
    return _stored(spark, sf_dir, "master_orders", lambda: master_orders(spark, sf_dir))


def _report(report: Callable[[DataFrame], DataFrame], **options) -> Query:
    return lambda spark, sf_dir: report(master_table(spark, sf_dir), **options)


def _kept_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of the reports after three loads, of which the later ones correct and complete the first."""

    def build() -> DataFrame:
        master, date = master_table(spark, sf_dir), F.col("order_date")
        wrong = master.withColumns(
            {
                "order_status": F.lit("Pending"),
                "customer_city": F.upper("customer_city"),
                "total_value": F.col("total_value") + 1,
                "quantity": F.col("quantity") + 1,
                "return_id": F.lit(None).cast(master.schema["return_id"].dataType),
            }
        )
        first, second = date < LOADS[0], date < LOADS[1]
        rest = F.coalesce(date >= LOADS[0], F.lit(True))
        states = [
            state_of(wrong.filter(second)),
            state_of(master.filter(first), wrong.filter(first)),
            state_of(master.filter(rest), wrong.filter(second & ~first)),
        ]
        return merged(states)

    return _stored(spark, sf_dir, "report_state", build)


def _state_report(name: str) -> Query:
    return lambda spark, sf_dir: state_reports()[name](_kept_state(spark, sf_dir))


def master_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_master_orders(_entities(spark, sf_dir), views.BUILT)


def master_orders_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_master_orders(_entities(spark, sf_dir, history=True), views.BUILT)


def master_orders_current_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_master_orders(
        _entities(spark, sf_dir, history=True), views.BUILT, current_only=True
    )


def master_orders_by_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_master_orders(
        _entities(spark, sf_dir), views.BUILT, address_key="address_id"
    )


def master_orders_every_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and amounts per status of the wide table without its status filter."""
    master = build_master_orders(_entities(spark, sf_dir), views.BUILT, status=None)
    return master.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("item_rows"),
        F.sum("total_value").cast("decimal(20,2)").alias("total_value"),
        F.sum("product_revenue").cast("decimal(31,4)").alias("product_revenue"),
    )


def sales_total_revenue_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.total_sales_revenue(analytics.order_grain(master_table(spark, sf_dir)))


def sales_total_revenue_by_order_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order joins a second version of its customer; each is still counted once."""
    master = master_table(spark, sf_dir)
    renamed = master.withColumn("customer_name", F.concat(F.lit("Former "), "customer_name"))
    return analytics.total_sales_revenue(analytics.order_grain(master.unionByName(renamed)))


def sales_average_order_value_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.average_order_value(analytics.order_grain(master_table(spark, sf_dir)))


# ---- de-duplication and typing ----------------------------------------------


def dedupe_latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.latest_lines(spark, sf_dir)


def dedupe_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    return dedupe_latest(events, ["user_id"], ["ts"])


def _orders_with_open_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    priority = F.when(~unknown, F.col("o_orderpriority"))
    return views.table(spark, sf_dir, "orders").withColumn("o_orderpriority", priority)


def dedupe_null_key_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five keys hold all rows; orders without a priority are one of the groups."""
    df = _orders_with_open_priority(spark, sf_dir)
    return dedupe_latest(df, ["o_orderpriority"], ["o_orderdate"])


def dedupe_drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _orders_with_open_priority(spark, sf_dir)
    return dedupe_latest(df, ["o_orderpriority"], ["o_orderdate"], drop_null_keys=True)


def conform_orders_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = views.source_columns({"orders": views.orders(spark, sf_dir)}, "orders")
    return conform_entity(text, ENTITIES["orders"])


def order_item_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = views.source_columns(_entities(spark, sf_dir), "order_items")
    return conform_entity(text, ENTITIES["order_items"])


def timezone_shift_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id", "ts", convert_timezone(F.col("ts")).alias("local_ts")
    )


def conform_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one status carry an unreadable date: typed rows and refused rows."""
    entity = ENTITIES["orders"]
    text = views.source_columns({"orders": views.orders(spark, sf_dir)}, "orders")
    shipped = F.col("order_status") == "Shipped"
    text = text.withColumn(
        "order_date", F.when(shipped, F.lit("not a date")).otherwise(F.col("order_date"))
    )
    good, bad = conform_or_quarantine(text, entity.fields)
    return good.select("order_id", "order_date", F.lit(None).cast("string").alias("bad")).unionByName(
        bad.select(
            F.col("order_id").cast("bigint"),
            F.lit(None).cast("date").alias("order_date"),
            F.concat_ws(",", "_bad_columns").alias("bad"),
        )
    )


# ---- merges -----------------------------------------------------------------


def _load(spark: SparkSession, sf_dir: str, number: int, loads: int = 2) -> DataFrame:
    """Orders of one load; the loads together are the whole table.

    Orders without a date are in the first load.
    """
    df = _orders_with_open_priority(spark, sf_dir)
    date = F.col("o_orderdate")
    if number > 0:
        df = df.filter(date >= views.ts(LOADS[number - 1]))
    if number < loads - 1:
        df = df.filter((date < views.ts(LOADS[number])) | date.isNull())
    return df


_TRACKED = ["priority", "status"]


def customer_state(
    spark: SparkSession, sf_dir: str, number: int, loads: int = 2
) -> DataFrame:
    """Latest order of each customer within one load."""
    rows = _load(spark, sf_dir, number, loads)
    latest = dedupe_latest(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return latest.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("last_order_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        views.ts(LOADS[number]).alias("last_updated_ts"),
    )


_DIM_SCHEMA = struct(
    [
        ("customer_id", T.LongType()),
        ("last_order_id", T.LongType()),
        ("priority", T.StringType()),
        ("status", T.StringType()),
        ("effective_start_date", T.TimestampNTZType()),
        ("effective_end_date", T.TimestampNTZType()),
        ("is_current", T.BooleanType()),
        ("last_updated_ts", T.TimestampNTZType()),
    ]
)


def _first_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension after the first load, as a stored table."""
    dim = scd2_pass(
        spark.createDataFrame([], _DIM_SCHEMA),
        customer_state(spark, sf_dir, 0),
        ["customer_id"],
        _TRACKED,
        LOADS[0],
        source_unique=True,
    )
    return materialise(dim, "dim")


def scd1_upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = customer_state(spark, sf_dir, 0).withColumns(
        {"is_active": F.lit("yes"), "first_load": F.lit("first")}
    )
    source = customer_state(spark, sf_dir, 1).drop("last_updated_ts")
    return scd1_upsert(target, source, ["customer_id"], run_ts=LOADS[1])


def scd1_ambiguous_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that a merge of single orders on the customer key would hit twice."""
    target = customer_state(spark, sf_dir, 0)
    source = _load(spark, sf_dir, 1).withColumnRenamed("o_custkey", "customer_id")
    return ambiguous_keys(target, source, ["customer_id"])


def _second_load(
    spark: SparkSession, sf_dir: str, merge=scd2_pass, null_safe: bool = False, loads: int = 2
) -> DataFrame:
    return merge(
        _first_dim(spark, sf_dir),
        customer_state(spark, sf_dir, 1, loads),
        ["customer_id"],
        _TRACKED,
        LOADS[1],
        null_safe=null_safe,
        source_unique=True,
    )


def scd2_pass_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second_load(spark, sf_dir)


def scd2_pass_null_safe_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second_load(spark, sf_dir, null_safe=True)


def scd2_second_pass_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same source merged again: successors of the closed versions appear."""
    once = materialise(_second_load(spark, sf_dir), "dim")
    source = customer_state(spark, sf_dir, 1)
    return scd2_pass(
        once, source, ["customer_id"], _TRACKED, LOADS[2], source_unique=True
    )


def _three_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = materialise(_second_load(spark, sf_dir, scd2_apply, loads=3), "dim")
    source = customer_state(spark, sf_dir, 2, loads=3)
    return scd2_apply(
        two, source, ["customer_id"], _TRACKED, LOADS[2], source_unique=True
    )


def scd2_apply_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _three_loads(spark, sf_dir)


def scd2_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of order lines by (order, line), lines shipped earlier or never loaded first."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = views.table(spark, sf_dir, "lineitem")
    early = F.coalesce(F.col("l_shipdate") < views.ts(LOADS[1]), F.lit(True))

    def state(rows: DataFrame, load: str) -> DataFrame:
        return (
            dedupe_latest(rows, keys, ["l_shipdate"])
            .select(*keys, "l_returnflag", "l_linestatus")
            .withColumn("last_updated_ts", views.ts(load))
        )

    dim = (
        state(lines.filter(early), LOADS[1])
        .withColumns(
            {
                "effective_start_date": views.ts(LOADS[1]),
                "effective_end_date": F.lit(None).cast("timestamp_ntz"),
                "is_current": F.lit(True),
            }
        )
    )
    return scd2_apply(
        materialise(dim, "dim"),
        state(lines.filter(~early), LOADS[2]),
        keys,
        ["l_returnflag", "l_linestatus"],
        LOADS[2],
        source_unique=True,
    )


def _dated_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    facts = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("ordered_at"),
    )
    return facts, materialise(_three_loads(spark, sf_dir), "dim")


def scd2_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the customer version valid on its day."""
    facts, dim = _dated_orders(spark, sf_dir)
    return as_of(facts, dim, ["customer_id"], "ordered_at", ["last_order_id", "priority"])


def scd2_point_in_time_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by one order of facts and versions."""
    facts, dim = _dated_orders(spark, sf_dir)
    return as_of_sweep(facts, dim, ["customer_id"], "ordered_at", ["last_order_id", "priority"])


def _fact_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    every = views.orders(spark, sf_dir).withColumn("last_updated_ts", views.ts(LOADS[0]))
    return every.filter(F.col("order_date") < views.ts(LOADS[1]).cast("date")), every


def merge_insert_only_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _fact_orders(spark, sf_dir)
    return merge_insert_only(target, source, ["order_id"], LOADS[2], source_unique=True)


def append_orders_double_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _fact_orders(spark, sf_dir)
    return append_rows(target, source, LOADS[2])


# ---- data quality -----------------------------------------------------------


def quality_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    deliveries = _entities(spark, sf_dir)["deliveries"]
    return check_not_null(deliveries, ENTITIES["deliveries"].required_columns)


def quality_unique_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.table(spark, sf_dir, "lineitem")
    return check_unique(lines, ["l_orderkey", "l_linenumber"])


def quality_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a line, as if every order had to have one."""
    return check_foreign_key(
        views.table(spark, sf_dir, "orders"),
        views.table(spark, sf_dir, "lineitem"),
        ["o_orderkey"],
        ["l_orderkey"],
    )


def quality_orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that no event names."""
    return orphan_rows(
        views.table(spark, sf_dir, "customer"),
        views.table(spark, sf_dir, "events"),
        ["c_custkey"],
        ["user_id"],
    )


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return assign_surrogate_key(orders, "order_sk", "o_orderkey")


def surrogate_keys_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys by a column that is sparse, repeats, and is NULL for open orders."""
    place = F.when(F.col("o_orderstatus") != "O", F.col("o_custkey") * 1_000_003)
    orders = views.table(spark, sf_dir, "orders").select(place.alias("place"), "o_orderkey")
    return assign_surrogate_key(orders, "order_sk", "place")


def _faulty_items(tables: dict[str, DataFrame]) -> DataFrame:
    """Items of one order are without a quantity, items of another name an unknown product."""
    first = F.col("order_id") % 97 == 0
    return tables["order_items"].withColumns(
        {
            "quantity": F.when(~first, F.col("quantity")),
            "product_id": F.when(F.col("order_id") % 89 == 0, F.lit(-1).cast("bigint")).otherwise(
                F.col("product_id")
            ),
        }
    )


def _violations(checks: dict[str, DataFrame]) -> DataFrame:
    found = [
        check.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
        for name, check in checks.items()
    ]
    return reduce(DataFrame.unionByName, found)


def quality_checks_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks of the order items, with the violations of each."""
    tables = _entities(spark, sf_dir)
    return _violations(check_entity(_faulty_items(tables), ENTITIES["order_items"], tables))


def quality_checks_items_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after two loads, of which the second brings the products and the rest of the items."""
    tables, layers = _entities(spark, sf_dir), _layers(spark, "checks")
    layers.create()
    items = _faulty_items(tables)
    checks = EntityChecks(layers, ENTITIES["order_items"], buckets=16)
    small = F.coalesce(F.col("quantity") <= 25, F.lit(False))
    checks.add(1, items.filter(small), parents={"orders": tables["orders"]})
    checks.add(2, items.filter(~small), parents={"products": tables["products"]})
    return _violations(checks.violations())


def _key_counts(spark: SparkSession, df: DataFrame, keys: list[str]) -> KeyCounts:
    layers = _layers(spark, "keys")
    layers.create()
    return KeyCounts(layers, "of_a_table", [df.schema[k] for k in keys], buckets=16)


def quality_unique_lineitem_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped late come with a second load and may repeat a key of the first."""
    lines = views.table(spark, sf_dir, "lineitem")
    kept = _key_counts(spark, lines, ["l_orderkey", "l_linenumber"])
    early = F.coalesce(F.col("l_shipdate") < LOADS[0], F.lit(False))
    for load, part in enumerate((lines.filter(early), lines.filter(~early)), start=1):
        kept.add(load, part)
    return kept.repeated()


def quality_orphans_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a line: all orders come first, their lines with two loads."""
    orders, lines = (views.table(spark, sf_dir, name) for name in ("orders", "lineitem"))
    kept = _key_counts(spark, orders, ["o_orderkey"])
    early = F.coalesce(F.col("l_shipdate") < LOADS[0], F.lit(False))
    kept.add(1, orders, parents=lines.filter(early), parent_columns=["l_orderkey"])
    kept.add(2, parents=lines.filter(~early), parent_columns=["l_orderkey"])
    return kept.orphans()


# ---- files ------------------------------------------------------------------


def _as_files(spark: SparkSession, df: DataFrame, name: str, compression: str = "none") -> str:
    path = scratch_path(spark, name)
    write_csv(df, path, compression=compression)
    return path


def _address_files(spark: SparkSession, sf_dir: str) -> str:
    """Addresses contain a line break and quotation marks."""
    name = "customer_addresses"
    text = views.source_columns({name: views.customer_addresses(spark, sf_dir)}, name)
    return _as_files(spark, text, name)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _address_files(spark, sf_dir)
    return scan_csv(spark, path, ENTITIES["customer_addresses"])


def csv_roundtrip_by_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, each read by as many tasks as it has blocks."""
    entity = ENTITIES["customer_addresses"]
    return scan_quoted(spark, _address_files(spark, sf_dir), entity).select(*entity.columns)


def csv_audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose audit columns are complete, by address country."""
    path = _address_files(spark, sf_dir)
    raw = read_raw(spark, path, ENTITIES["customer_addresses"], LOADS[0])
    return raw.groupBy("country").agg(
        F.count_if(
            F.col("_stg_file_name").endswith(".csv")
            & F.col("_stg_file_load_ts").isNotNull()
            & F.col("_stg_file_md5").rlike("^[0-9a-f]{32}$")
        ).alias("audited_rows"),
        F.max("_copy_data_ts").alias("copied_at"),
    )


def csv_inline_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns with their date typed while reading."""
    rows = views.source_columns(_entities(spark, sf_dir), "returns")
    path = _as_files(spark, rows, "returns")
    return scan_typed(spark, path, ENTITIES["returns"], ["return_date"])


def csv_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order status written as each null token, an empty field or an empty string."""
    orders = views.table(spark, sf_dir, "orders")
    token = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "NULL")
        .when(F.col("o_orderpriority") == "2-HIGH", "null")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "\\N")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", '""')
        .otherwise("")
    )
    line = F.concat_ws(
        ",",
        "o_orderkey",
        "o_custkey",
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        token,
        F.lit("1.00"),
        F.lit("1"),
    )
    path = scratch_path(spark, "null-tokens")
    orders.select(line.alias("value")).write.text(path)
    entity = ENTITIES["orders"]
    return scan_csv(spark, path, entity, header=False).select("order_id", "order_status")


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one status carry a surplus field: rows accepted and lines refused."""
    surplus = F.when(F.col("o_orderstatus") == "P", ",surplus").otherwise("")
    line = F.concat(
        F.concat_ws(
            ",",
            "o_orderkey",
            "o_custkey",
            F.date_format("o_orderdate", "yyyy-MM-dd"),
            "o_orderstatus",
            F.lit("1.00"),
            F.lit("1"),
        ),
        surplus,
    )
    path = scratch_path(spark, "quarantine")
    views.table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    good, bad = read_or_quarantine(spark, path, ENTITIES["orders"], header=False)
    return good.select("order_id", F.lit(None).cast("string").alias("refused_line")).unionByName(
        bad.select(
            F.substring_index("_corrupt_record", ",", 1).alias("order_id"),
            F.col("_corrupt_record").alias("refused_line"),
        )
    )


def csv_file_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content key, rows and size of each file; one file of order lines for each status."""
    orders = views.table(spark, sf_dir, "orders")
    line = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch_path(spark, "file-keys")
    one = orders.select("o_orderstatus", "o_orderkey", line.alias("value")).repartition("o_orderstatus")
    one = one.sortWithinPartitions("o_orderstatus", "o_orderkey").drop("o_orderkey")
    one.write.partitionBy("o_orderstatus").text(path)
    status = F.regexp_extract("file_name", "o_orderstatus=([^/]*)/", 1)
    keys = content_keys(spark, path, "*.txt").select(status.alias("order_status"), "content_key")
    sizes = list_files(spark, path, "*.txt").select(status.alias("order_status"), "file_size")
    return keys.join(sizes, "order_status")


def stage_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of a listing of all orders, written by status."""
    path = scratch_path(spark, "stage")
    orders = views.table(spark, sf_dir, "orders")
    orders.write.partitionBy("o_orderstatus").option("header", "true").csv(path)
    files = list_files(spark, path, "*.csv")
    status = F.regexp_extract("file_name", "o_orderstatus=([^/]*)/", 1)
    return files.groupBy(status.alias("order_status")).agg(
        F.min(F.col("file_size") > 0).alias("all_filled")
    )


# ---- loads through the layers --------------------------------------------------------------


def _layers(spark: SparkSession, name: str) -> Layers:
    location = scratch_path(spark, name)
    return Layers(spark, prefix=os.path.basename(location).replace("-", "_") + "_", location=location)


def _customer_drops(spark: SparkSession, sf_dir: str) -> list[str]:
    """Two deliveries of the customer file; one segment has new numbers in the second."""
    first = views.source_columns({"customers": views.customers(spark, sf_dir)}, "customers")
    new_number = F.concat(F.lit("1"), F.col("phone_number"))
    second = first.withColumn(
        "phone_number",
        F.when(F.col("gender") == "Female", new_number).otherwise(F.col("phone_number")),
    )
    return [_as_files(spark, df, "customers") for df in (first, second)]


def _two_customer_loads(spark: SparkSession, sf_dir: str, options: LoadOptions) -> Layers:
    layers = _layers(spark, "customers")
    layers.create()
    for path, run_ts in zip(_customer_drops(spark, sf_dir), LOADS):
        run_entity(layers, ENTITIES["customers"], path, run_ts, options)
    return layers


def load_clean_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _two_customer_loads(spark, sf_dir, LoadOptions())
    return layers.table(CLEAN, "clean_customers").select(
        "customer_id", "gender", "phone_number", "dob", "last_updated_ts", "is_active", "_copy_data_ts"
    )


def load_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_customer_loads(spark, sf_dir, LoadOptions()).table(CURATED, "dim_customers")


def load_dim_customers_two_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = LoadOptions(two_step_versions=True, buckets=8)
    return _two_customer_loads(spark, sf_dir, options).table(CURATED, "dim_customers")


def _by_bucket(spark: SparkSession, sf_dir: str) -> Layers:
    """Two incremental loads, of which the second rewrites the buckets of the changed customers only."""
    layers = _layers(spark, "buckets")
    layers.create()
    first, second = _customer_drops(spark, sf_dir)
    for path, run_ts in ((first, LOADS[0]), (second, LOADS[1])):
        options = LoadOptions(rewrite_buckets=16, since=run_ts)
        run_entity(layers, ENTITIES["customers"], path, run_ts, options)
    return layers


def load_clean_customers_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_bucket(spark, sf_dir).table(CLEAN, "clean_customers").select(
        "customer_id", "gender", "phone_number", "dob", "last_updated_ts", "is_active", "_copy_data_ts"
    )


def load_dim_customers_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current versions in buckets, closed ones in segments that are written once."""
    return _by_bucket(spark, sf_dir).table(CURATED, "dim_customers")


def load_raw_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that ends before it is published, then the same load again: every row once."""
    entity = ENTITIES["orders"]
    text = views.source_columns({"orders": views.orders(spark, sf_dir)}, "orders")
    path = _as_files(spark, text, "orders")
    layers = _layers(spark, "raw_orders")
    layers.create()
    raw = Landing(layers, RAW, entity.raw_table, entity.raw_schema)
    raw.create()
    raw.land(read_raw(spark, path, entity, LOADS[0]))
    for run_ts in LOADS[1:3]:  # the second of these finds nothing new
        load_raw(layers, entity, path, run_ts)
    return layers.table(RAW, entity.raw_table).select(*entity.columns, "_copy_data_ts")


def load_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status change after the first load reaches the clean layer only."""
    entity = ENTITIES["orders"]
    first = views.source_columns({"orders": views.orders(spark, sf_dir)}, "orders")
    second = first.withColumn("order_status", F.lit("Cancelled"))
    layers = _layers(spark, "orders")
    layers.create()
    for df, run_ts in zip((first, second), LOADS):
        load_raw(layers, entity, _as_files(spark, df, "orders"), run_ts)
        load_clean(layers, entity, run_ts)
        load_curated(layers, entity, run_ts)
    fact = layers.table(CURATED, "fact_orders")
    clean = layers.table(CLEAN, "clean_orders").select(
        "order_id", F.col("order_status").alias("clean_status")
    )
    return fact.join(clean, "order_id")


def load_clean_orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean layer of orders as a log: the second load only appends."""
    entity = ENTITIES["orders"]
    first = views.source_columns({"orders": views.orders(spark, sf_dir)}, "orders")
    second = first.filter(F.col("order_status") == "Pending").withColumn(
        "order_status", F.lit("Delivered")
    )
    layers = _layers(spark, "orders_log")
    layers.create()
    for df, run_ts in zip((first, second), LOADS):
        options = LoadOptions(log_facts=True, since=run_ts)
        load_raw(layers, entity, _as_files(spark, df, "orders"), run_ts)
        load_clean(layers, entity, run_ts, options)
    return layers.table(CLEAN, entity.clean_table).select(*entity.columns, "last_updated_ts")


def _late_file(spark: SparkSession, sf_dir: str, options: list[LoadOptions]) -> DataFrame:
    """A file of orders is loaded after a newer one; the newer rows stay."""
    entity = ENTITIES["orders"]
    newer = views.source_columns({"orders": views.orders(spark, sf_dir)}, "orders")
    older = newer.withColumn("order_status", F.lit("Outdated"))
    paths = [_as_files(spark, df, "orders") for df in (older, newer)]
    layers = _layers(spark, "orders_late")
    layers.create()
    for path, run_ts, choice in zip(reversed(paths), LOADS, options):
        load_raw(layers, entity, path, run_ts)
        load_clean(layers, entity, run_ts, choice)
    return layers.table(CLEAN, entity.clean_table).select(*entity.columns)


def load_clean_orders_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_file(spark, sf_dir, [LoadOptions(), LoadOptions()])


def load_clean_orders_late_file_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_file(spark, sf_dir, [LoadOptions(since=run_ts) for run_ts in LOADS[:2]])


def load_clean_orders_late_file_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = [LoadOptions(since=run_ts, log_facts=True) for run_ts in LOADS[:2]]
    return _late_file(spark, sf_dir, options)


def load_fact_returns_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run on the same files adds no returns."""
    entity = ENTITIES["returns"]
    path = _as_files(spark, views.source_columns(_entities(spark, sf_dir), "returns"), "returns")
    layers = _layers(spark, "returns")
    layers.create()
    for run_ts in LOADS[:2]:
        run_entity(layers, entity, path, run_ts)
    return layers.table(CURATED, entity.curated_table)


def load_fact_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments from their file through the clean to the fact table."""
    entity = ENTITIES["payments"]
    text = views.source_columns({"payments": views.payments(spark, sf_dir)}, "payments")
    layers = _layers(spark, "payments")
    layers.create()
    run_entity(layers, entity, _as_files(spark, text, "payments"), LOADS[0])
    return layers.table(CURATED, entity.curated_table)


def load_master_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entities from files to the wide table through all layers."""
    tables = _entities(spark, sf_dir)
    # the file of deliveries must name a partner: -1 stands for none
    tables["deliveries"] = tables["deliveries"].withColumn(
        "delivery_partner_id", F.coalesce("delivery_partner_id", F.lit("-1"))
    )
    layers = _layers(spark, "warehouse")
    # files are written from splits of bounded size, so one task can read one; those with line breaks are divided
    paths = {
        name: _as_files(
            spark, views.source_columns(tables, name), name, "none" if ENTITIES[name].multi_line else "gzip"
        )
        for name in DIMENSIONS + FACTS
    }
    run_all(layers, paths, views.BUILT, LoadOptions(remove_loaded=True))
    return layers.table(CURATED, "master_orders")


def _grown(spark: SparkSession, sf_dir: str) -> list[dict[str, DataFrame]]:
    """Curated tables after each of two loads. The second adds the orders since 1997 with their facts, and closes
    the earlier version of small products for the present one."""
    tables = _entities(spark, sf_dir, history=True)
    small = F.col("category") == "SMALL"
    present = small & F.col("is_current")
    products = tables["products"]
    after = products.withColumn(
        "effective_start_date",
        F.when(present, views.ts(views.CLOSED)).otherwise(F.col("effective_start_date")),
    )
    before = products.filter(~present).withColumns(
        {"effective_end_date": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True)}
    )
    later = F.coalesce(F.col("order_date") >= "1997-01-01", F.lit(False))
    orders = tables["orders"]
    old = orders.filter(~later).select("order_id")
    states = [{**tables, "products": before}, {**tables, "products": after}]
    for name in FACTS:
        first = tables[name].join(old, "order_id", "left_semi")
        rest = tables[name].join(old, "order_id", "left_anti")
        states[0][name] = first.withColumn("last_updated_ts", views.ts(views.LOADED))
        states[1][name] = states[0][name].unionByName(
            rest.withColumn("last_updated_ts", views.ts(views.CLOSED))
        )
    return states


def refresh_master_by_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table after a second load, of which only the orders that it changed were joined again."""
    layers = _layers(spark, "refresh")
    layers.create()
    for tables, run_ts in zip(_grown(spark, sf_dir), (views.LOADED, views.BUILT)):
        refresh_master_orders(layers, tables, run_ts, buckets=16)
    return layers.table(CURATED, MASTER)


def stream_raw_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files picked up by an incremental read, some before and some after a restart."""
    entity = ENTITIES["payments"]
    source, target = scratch_path(spark, "incoming"), scratch_path(spark, "raw")
    payments = views.source_columns({"payments": views.payments(spark, sf_dir)}, "payments")
    open_payment = F.col("payment_status") == "Pending"
    for part in (payments.filter(open_payment), payments.filter(~open_payment)):
        write_csv(part, source, mode="append")
        stream = raw_stream(spark, source, entity, LOADS[0])
        ingest_available(stream, target, f"{target}-checkpoint").awaitTermination()
    return spark.read.parquet(target).select(*entity.columns, "_copy_data_ts")


def _upserted(spark: SparkSession, sf_dir: str, buckets: int) -> DataFrame:
    """Versions of customers kept up by micro-batches over two deliveries."""
    entity = ENTITIES["customers"]
    layers = _layers(spark, "stream")
    layers.create()
    folder, checkpoint = scratch_path(spark, "incoming"), scratch_path(spark, "checkpoint")
    first = views.source_columns({"customers": views.customers(spark, sf_dir)}, "customers")
    second = first.withColumn("phone_number", F.concat(F.lit("1"), F.col("phone_number")))
    for df, run_ts in zip((first, second), LOADS):
        write_csv(df, folder, mode="append")
        stream = raw_stream(spark, folder, entity, run_ts)
        upsert_available(
            stream, layers, entity, checkpoint, run_ts, versions=True, buckets=buckets
        ).awaitTermination()
    return layers.table(CURATED, entity.curated_table)


def stream_upsert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, buckets=0)


def stream_upsert_customers_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, buckets=16)


def _streamed(spark: SparkSession, layers: Layers, df: DataFrame, run_ts: str) -> None:
    """One delivery of customers by a stream of its own."""
    entity, folder = ENTITIES["customers"], scratch_path(spark, "incoming")
    write_csv(df, folder)
    upsert_available(
        raw_stream(spark, folder, entity, run_ts),
        layers,
        entity,
        scratch_path(spark, "checkpoint"),
        run_ts,
        versions=True,
    ).awaitTermination()


def _by_gender(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    customers = views.source_columns({"customers": views.customers(spark, sf_dir)}, "customers")
    female = F.col("gender") == "Female"
    return [customers.filter(female), customers.filter(~female)]


def stream_after_batch_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch load, then a stream of other customers: the dimension holds both."""
    layers = _layers(spark, "shared")
    layers.create()
    first, second = _by_gender(spark, sf_dir)
    run_entity(layers, ENTITIES["customers"], _as_files(spark, first, "customers"), LOADS[0])
    _streamed(spark, layers, second, LOADS[1])
    return layers.table(CURATED, ENTITIES["customers"].curated_table)


def batch_between_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with a batch load between them; the last one changes the first one's rows."""
    layers = _layers(spark, "between")
    layers.create()
    first, second = _by_gender(spark, sf_dir)
    _streamed(spark, layers, first, LOADS[0])
    run_entity(layers, ENTITIES["customers"], _as_files(spark, second, "customers"), LOADS[1])
    changed = first.withColumn("phone_number", F.concat(F.lit("1"), F.col("phone_number")))
    _streamed(spark, layers, changed, LOADS[2])
    return layers.table(CURATED, ENTITIES["customers"].curated_table)


# ---- beyond the wide table --------------------------------------------------


def purchases_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.purchases_by_hour(views.table(spark, sf_dir, "events"))


def visitor_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.visitor_conversion(views.table(spark, sf_dir, "events"))


def payments_by_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.payments_by_method(views.payments(spark, sf_dir))


OPERATORS: list[Query] = [
    master_orders,
    master_orders_all_versions,
    master_orders_current_only,
    master_orders_by_address,
    master_orders_every_status,
    sales_total_revenue_by_order,
    sales_total_revenue_by_order_renamed,
    sales_average_order_value_by_order,
    dedupe_latest_lineitem,
    dedupe_latest_events,
    dedupe_null_key_group,
    dedupe_drop_null_keys,
    conform_orders_types,
    conform_quarantine,
    order_item_totals,
    timezone_shift_events,
    scd1_upsert_orders,
    scd1_ambiguous_keys,
    scd2_pass_orders,
    scd2_pass_null_safe_orders,
    scd2_second_pass_orders,
    scd2_apply_orders,
    scd2_composite_key,
    scd2_point_in_time,
    scd2_point_in_time_sweep,
    merge_insert_only_orders,
    append_orders_double_load,
    quality_not_null,
    quality_unique_lineitem,
    quality_orphans,
    quality_orphan_rows,
    surrogate_keys,
    surrogate_keys_sparse,
    quality_checks_items,
    quality_checks_items_by_load,
    quality_unique_lineitem_by_load,
    quality_orphans_by_load,
    csv_roundtrip,
    csv_roundtrip_by_blocks,
    csv_audit_columns,
    csv_inline_cast,
    csv_null_tokens,
    csv_quarantine,
    csv_file_keys,
    stage_listing,
    load_clean_customers,
    load_dim_customers,
    load_dim_customers_two_step,
    load_clean_customers_by_bucket,
    load_dim_customers_by_segment,
    load_raw_after_failure,
    load_fact_orders,
    load_clean_orders_log,
    load_clean_orders_late_file,
    load_clean_orders_late_file_incremental,
    load_clean_orders_late_file_log,
    load_fact_returns_twice,
    load_fact_payments,
    load_master_orders,
    refresh_master_by_orders,
    stream_raw_ingest,
    stream_upsert_customers,
    stream_upsert_customers_by_bucket,
    stream_after_batch_customers,
    batch_between_streams,
    purchases_by_hour,
    visitor_conversion,
    payments_by_method,
]


def _configured(query: Query) -> Query:
    return lambda spark, sf_dir: query(configure(spark), sf_dir)


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {n: _report(f) for n, f in analytics.REPORTS.items()}
    found["cust_avg_orders_distinct"] = _report(
        analytics.average_orders_per_customer, distinct_orders=True
    )
    found["cust_retention_rate_distinct"] = _report(
        analytics.customer_retention_rate, distinct_orders=True
    )
    found["cust_unique_bitmap"] = _report(analytics.unique_customers_by_bitmap)
    for name, key in (("cust_by_city_bitmap", "customer_city"), ("cust_by_gender_bitmap", "gender")):
        found[name] = _report(analytics.customers_and_sales_by_bitmap, key=key)
    found["sales_conversion_rate_bitmap"] = _report(analytics.sales_conversion_rate_by_bitmap)
    found.update({f"{name}_by_state": _state_report(name) for name in analytics.REPORTS})
    found.update({query.__name__: query for query in OPERATORS})
    return {name: _configured(query) for name, query in found.items()}
