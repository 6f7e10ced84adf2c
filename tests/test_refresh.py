"""The wide table brought up to date by the orders that changed."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tiermart.plans import analytics, loads, report_state
from tiermart.plans.loads import LoadOptions, curated_tables, load_master_orders, run_all
from tiermart.plans.refresh import MASTER, kept_reports, master_segments, refresh_master_orders
from tiermart.plans.wide import FACTS, MASTER_COLUMNS, build_master_orders
from tiermart.schemas import ENTITIES, IS_CURRENT, UPDATED_TS, VALID_FROM, VALID_TO
from tiermart.session import scratch_path
from tiermart.sources.segments import Segments
from tiermart.sources.tables import CURATED, Layers

TIMES = [f"2024-0{m}-01 00:00:00" for m in range(1, 7)]
BUCKETS = 16
N = 60


@pytest.fixture(autouse=True)
def leave_small_tables(look_at_small_tables, monkeypatch):
    """Hot keys of the wide table have tests of their own."""
    monkeypatch.setattr("tiermart.operators.skew.SMALLEST_TABLE", 64 << 20)


@pytest.fixture
def layers(spark):
    location = scratch_path(spark, "refresh")
    made = Layers(spark, "r" + location[-8:] + "_", location)
    made.create()
    yield made
    made.drop_all()


def _rows(spark, name, data, stamp):
    """Curated rows of an entity from (id, ...) values of its first columns; the rest is null."""
    entity = ENTITIES[name]
    names = entity.typed_columns
    df = spark.createDataFrame([tuple(str(v) for v in r) for r in data], names[: len(data[0])])
    fixed = {VALID_FROM: stamp, UPDATED_TS: stamp, IS_CURRENT: "true"}
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(fixed.get(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in entity.curated_schema
        ]
    ).coalesce(1)


_STORED = {}


def _warehouse(spark):
    """Small inputs: N orders of 10 customers, 3 products, 2 partners; stored once."""
    if _STORED:
        return {name: spark.read.schema(schema).parquet(path) for name, (path, schema) in _STORED.items()}
    made = {
        "products": [(i, f"P{i}", "Tea", 2.5, 7) for i in range(3)],
        "customers": [(i, f"C{i}", "Female", "x", "1990-01-01", "01", "2020-01-01") for i in range(10)],
        "customer_addresses": [(100 + i, i, "Road", f"City{i % 3}", "S", "1", "In") for i in range(10)],
        "delivery_partners": [(i, f"D{i}", "06", "N") for i in range(2)],
        "orders": [
            (i, i % 10, "2024-01-03", "Delivered" if i % 5 else "Pending", 50, 100 + i % 10) for i in range(N)
        ],
        "order_items": [(i, i // 2, i % 3, 2, 2.0) for i in range(2 * N)],
        "deliveries": [(i, i, "2024-01-05", "Delivered", i % 2, "T") for i in range(N)],
        "returns": [(i, 3 * i, 0, "2024-01-09", "Damaged") for i in range(10)],
    }
    for name, data in made.items():
        path = scratch_path(spark, name)
        _rows(spark, name, data, TIMES[0]).coalesce(1).write.parquet(path)
        _STORED[name] = (path, ENTITIES[name].curated_schema)
    return _warehouse(spark)


def _add(tables, name, more):
    """With rows of one more load."""
    return {**tables, name: tables[name].unionByName(more)}


def _changed(tables, name, key, column, value, stamp):
    """A version closed, and its successor opened."""
    table, hit = tables[name], (F.col(key[0]) == key[1]) & F.col(IS_CURRENT)
    now = F.lit(stamp).cast("timestamp_ntz")
    kind = table.schema[column].dataType
    opened = table.filter(hit).withColumns(
        {column: F.lit(value).cast(kind), VALID_FROM: now, UPDATED_TS: now}
    )
    closed = table.withColumns(
        {VALID_TO: F.when(hit, now).otherwise(F.col(VALID_TO)), IS_CURRENT: F.col(IS_CURRENT) & ~hit}
    )
    return {**tables, name: closed.unionByName(opened)}


def _shown(layers, but=("data_insert_ts",)):
    return rows(layers.table(CURATED, MASTER).drop(*but))


def _anew(tables, **choices):
    return rows(build_master_orders(tables, TIMES[0], **choices).drop("data_insert_ts"))


def _orders_at(layers, stamp):
    found = layers.table(CURATED, MASTER).filter(F.col("data_insert_ts") == F.lit(stamp).cast("timestamp_ntz"))
    return {r[0] for r in found.select("order_id").distinct().collect()}


# one change of each input, and the orders that it reaches
CHANGES = {
    "orders": lambda s, t: _add(t, "orders", _rows(s, "orders", [(7, 3, "2024-02-01", "Delivered", 9, 103)], TIMES[1])),
    "order_items": lambda s, t: _add(t, "order_items", _rows(s, "order_items", [(900, 8, 1, 5, 2.0)], TIMES[1])),
    "deliveries": lambda s, t: _add(t, "deliveries", _rows(s, "deliveries", [(900, 9, "2024-02-02", "Lost", 1, "U")], TIMES[1])),
    "returns": lambda s, t: _add(t, "returns", _rows(s, "returns", [(900, 11, 1, "2024-02-02", "Late")], TIMES[1])),
    "products": lambda s, t: _changed(t, "products", ("product_id", 1), "price", 3, TIMES[1]),
    "customers": lambda s, t: _changed(t, "customers", ("customer_id", 4), "phone_number", "99", TIMES[1]),
    "customer_addresses": lambda s, t: _changed(t, "customer_addresses", ("address_id", 106), "customer_id", 2, TIMES[1]),
    "delivery_partners": lambda s, t: _changed(t, "delivery_partners", ("delivery_partner_id", 0), "partner_name", "E", TIMES[1]),
}
REACHED = {
    "orders": {7},
    "order_items": {8},
    "deliveries": {9},
    "returns": {11},
    "products": {i // 2 for i in range(2 * N) if i % 3 == 1},
    "customers": {i for i in range(N) if i % 10 == 4},
    # of the customer that the address had and of the one that it has now
    "customer_addresses": {i for i in range(N) if i % 10 in (2, 6)},
    "delivery_partners": {i for i in range(N) if i % 2 == 0},
}


@pytest.mark.parametrize("names", [FACTS, ["products"], ["customer_addresses"], ["customers", "delivery_partners"]])
def test_a_change_of_any_input_reaches_its_orders_only(spark, layers, names):
    tables = _warehouse(spark)
    assert refresh_master_orders(layers, tables, TIMES[0], BUCKETS).whole
    assert _shown(layers) == _anew(tables)
    held = master_segments(layers, tables, BUCKETS)
    before = held.versions()
    for name in names:
        tables = CHANGES[name](spark, tables)
    done = refresh_master_orders(layers, tables, TIMES[1], BUCKETS)
    assert not done.whole
    assert _shown(layers) == _anew(tables)
    reached_ids = set().union(*[REACHED[name] for name in names])
    delivered = {i for i in reached_ids if i % 5}
    assert _orders_at(layers, TIMES[1]) == delivered
    # buckets of other orders keep their version
    reached = spark.createDataFrame([(i,) for i in reached_ids], "order_id long")
    assert list(done.touched) == held.touched(reached)
    assert [b for b in range(BUCKETS) if held.versions()[b] != before[b]] == list(done.touched)
    # nothing is new any more
    versions = held.versions()
    assert refresh_master_orders(layers, tables, TIMES[2], BUCKETS).touched == []
    assert held.versions() == versions


def test_choices_of_the_wide_table(spark, layers):
    choices = {"current_only": True, "address_key": "address_id", "status": None}
    tables = _warehouse(spark)
    refresh_master_orders(layers, tables, TIMES[0], BUCKETS, **choices)
    for name in ("customers", "customer_addresses", "orders"):
        tables = CHANGES[name](spark, tables)
    done = refresh_master_orders(layers, tables, TIMES[1], BUCKETS, **choices)
    assert not done.whole and 0 < len(done.touched) < BUCKETS
    assert _shown(layers) == _anew(tables, **choices)
    # other choices build the table anew
    assert refresh_master_orders(layers, tables, TIMES[2], BUCKETS).whole
    assert _shown(layers) == _anew(tables)


def test_loads_with_the_same_or_an_earlier_stamp(spark, layers):
    tables = _warehouse(spark)
    late = _rows(spark, "returns", [(901, 12, 1, "2024-02-02", "Late")], TIMES[3])
    tables = _add(tables, "returns", late)
    refresh_master_orders(layers, tables, TIMES[3], BUCKETS)
    # a second load of the same time: rows of that time are looked at again
    tables = _add(tables, "returns", _rows(spark, "returns", [(902, 13, 2, "2024-02-02", "Late")], TIMES[3]))
    assert not refresh_master_orders(layers, tables, TIMES[4], BUCKETS).whole
    assert _shown(layers) == _anew(tables) and _orders_at(layers, TIMES[4]) == {12, 13}
    # a load that is stamped in the past
    tables = _add(tables, "returns", _rows(spark, "returns", [(903, 14, 1, "2024-02-02", "Late")], TIMES[2]))
    assert refresh_master_orders(layers, tables, TIMES[5], BUCKETS).whole
    assert _shown(layers) == _anew(tables)


def test_a_failed_refresh_is_repeated(spark, layers, monkeypatch):
    tables = _warehouse(spark)
    refresh_master_orders(layers, tables, TIMES[0], BUCKETS)
    before = _shown(layers, but=())
    tables = CHANGES["products"](spark, tables)

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Segments, "_publish", fail)
        with pytest.raises(OSError):
            refresh_master_orders(layers, tables, TIMES[1], BUCKETS)
    assert _shown(layers, but=()) == before
    assert refresh_master_orders(layers, tables, TIMES[2], BUCKETS).touched
    assert _shown(layers) == _anew(tables)


def test_empty_inputs_and_rows_of_no_order(spark, layers):
    full = _warehouse(spark)
    tables = {name: table.limit(0) for name, table in full.items()}
    refresh_master_orders(layers, tables, TIMES[0], BUCKETS)
    assert _shown(layers) == [] and layers.table(CURATED, MASTER).columns == MASTER_COLUMNS
    # a customer without orders: seen, nothing written
    tables = {**tables, "customers": full["customers"]}
    assert refresh_master_orders(layers, tables, TIMES[1], BUCKETS).touched == []
    refresh_master_orders(layers, full, TIMES[2], BUCKETS)
    assert _shown(layers) == _anew(full)
    # a null order id belongs to no order
    tables = _add(full, "returns", _rows(spark, "returns", [(1, 2, 3)], TIMES[3]).withColumn("order_id", F.lit(None).cast("long")))
    assert refresh_master_orders(layers, tables, TIMES[3], BUCKETS).touched == []
    assert _shown(layers) == _anew(tables)


def test_loads_from_files_refresh_the_wide_table(spark, layers, tmp_path):
    from test_loads import FILES, _write

    paths = {name: _write(str(tmp_path / "a"), name, lines) for name, lines in FILES.items()}
    run_all(layers, paths, TIMES[0], LoadOptions(rewrite_buckets=BUCKETS, since=TIMES[0]))
    more = {
        "customers": ["1,Ann,Female,new@x,1990-01-01,0999,2020-01-01"],
        "orders": ["102,2,2024-01-06,Delivered,30.00,12"],
        "order_items": ["1002,102,5,1,2.00"],
        "deliveries": ["8,102,2024-01-07,Delivered,1,T8"],
    }
    paths.update({name: _write(str(tmp_path / "b"), name, lines) for name, lines in more.items()})
    run_all(layers, paths, TIMES[1], LoadOptions(rewrite_buckets=BUCKETS, since=TIMES[1]))
    shown = _shown(layers)
    assert shown == _anew(curated_tables(layers)) and len(shown) == 5
    # a table built whole takes its place, and the other way round
    load_master_orders(layers, TIMES[2])
    assert _shown(layers) == shown
    load_master_orders(layers, TIMES[3], rewrite_buckets=BUCKETS)
    assert _shown(layers) == shown


def test_large_facts_are_joined_in_parts_and_published_once(spark, layers, monkeypatch):
    tables, parts = _warehouse(spark), []

    def build(part, *args, **choices):
        parts.append(part)
        if len(parts) == lost:
            raise OSError("lost")
        return build_master_orders(part, *args, **choices)

    monkeypatch.setattr(loads, "curated_tables", lambda _: tables)
    monkeypatch.setattr(loads, "build_master_orders", build)
    lost = 0
    load_master_orders(layers, TIMES[0])
    assert len(parts) == 1 and _shown(layers) == _anew(tables)
    # 600 bytes and more each: as many parts as there may be
    monkeypatch.setattr(loads, "PART_BYTES", 64)
    parts.clear()
    load_master_orders(layers)
    assert len(parts) == loads.PARTS and _shown(layers) == _anew(tables)
    # one time for all of them, and every fact in one part
    assert layers.table(CURATED, MASTER).select("data_insert_ts").distinct().count() == 1
    for name in FACTS:
        counts = [part[name].count() for part in parts]
        assert sum(counts) == tables[name].count() and max(counts) < sum(counts), name
    # a part that fails publishes nothing
    before = rows(layers.table(CURATED, MASTER))
    parts.clear()
    lost = 3
    with pytest.raises(OSError):
        load_master_orders(layers, TIMES[1])
    assert rows(layers.table(CURATED, MASTER)) == before
    lost = 0
    load_master_orders(layers, TIMES[2])
    assert _shown(layers) == _anew(tables) and _orders_at(layers, TIMES[2]) == {r[0] for r in _anew(tables)}


def _same_reports(layers, state):
    """All 19 reports of the state against those of the wide table itself."""
    master = layers.table(CURATED, MASTER)
    kept, different = report_state.state_reports(), []
    assert list(kept) == list(analytics.REPORTS)
    for name, report in analytics.REPORTS.items():
        got, want = kept[name](state), report(master)
        if rows(got) != rows(want) or got.dtypes != want.dtypes:
            different.append((name, rows(got), rows(want)))
    assert different == []


@pytest.mark.parametrize("choices", [{}, {"status": None}])
def test_reports_of_kept_states_after_three_loads(spark, layers, choices, monkeypatch):
    tables = _warehouse(spark)
    with pytest.raises(ValueError):
        kept_reports(layers, tables, BUCKETS, **choices)
    refresh_master_orders(layers, tables, TIMES[0], BUCKETS, reports=True, **choices)
    for name in ("orders", "order_items", "returns"):
        tables = CHANGES[name](spark, tables)
    assert not refresh_master_orders(layers, tables, TIMES[1], BUCKETS, reports=True, **choices).whole
    _same_reports(layers, kept_reports(layers, tables, BUCKETS, **choices).persist())
    # customers leave cities, a partner is renamed; then nothing is new
    moved = [("customer_addresses", ("address_id", 106), "city", "Far"), ("customers", ("customer_id", 4), "name", "New")]
    for name, key, column, value in moved:
        tables = _changed(tables, name, key, column, value, TIMES[2])
    monkeypatch.setattr(report_state, "MOST_LOADS", 2)  # the third load folds the states into one
    for _ in range(2):
        assert not refresh_master_orders(layers, tables, TIMES[2], BUCKETS, reports=True, **choices).whole
    _same_reports(layers, kept_reports(layers, tables, BUCKETS, **choices).persist())
    stored = layers.table(CURATED, report_state.TABLE)
    assert stored.select(report_state.LOAD).distinct().count() == 1
    # without reports no state counts any more, and the next refresh with them begins anew
    tables = CHANGES["deliveries"](spark, tables)
    refresh_master_orders(layers, tables, TIMES[3], BUCKETS, **choices)
    with pytest.raises(ValueError):
        kept_reports(layers, tables, BUCKETS, **choices)
    assert refresh_master_orders(layers, tables, TIMES[4], BUCKETS, reports=True, **choices).whole
    _same_reports(layers, kept_reports(layers, tables, BUCKETS, **choices).persist())


def test_reports_after_a_failed_refresh_and_of_no_rows(spark, layers, monkeypatch):
    full = _warehouse(spark)
    tables = {name: table.limit(0) for name, table in full.items()}
    refresh_master_orders(layers, tables, TIMES[0], BUCKETS, reports=True)
    _same_reports(layers, kept_reports(layers, tables, BUCKETS))
    refresh_master_orders(layers, full, TIMES[1], BUCKETS, reports=True)
    tables = CHANGES["orders"](spark, full)

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Segments, "_publish", fail)
        with pytest.raises(OSError):
            refresh_master_orders(layers, tables, TIMES[2], BUCKETS, reports=True)
    _same_reports(layers, kept_reports(layers, full, BUCKETS))
    assert not refresh_master_orders(layers, tables, TIMES[3], BUCKETS, reports=True).whole
    _same_reports(layers, kept_reports(layers, tables, BUCKETS))
