import os

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tiermart.plans import loads, registry
from tiermart.plans.loads import LoadOptions, load_clean, load_raw, run_all, run_entity
from tiermart.schemas import ENTITIES
from tiermart.session import scratch_path
from tiermart.sources.tables import CLEAN, COMMON, CURATED, RAW, Layers

RUNS = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"]

FILES = {
    "customers": [
        "1,Ann,Female,a@x,1990-01-01,0123,2020-01-01",
        "2,Bob,Male,b@x,1991-01-01,0456,2020-01-02",
    ],
    "customer_addresses": ["10,1,Road,Delhi,Delhi,01,India", "11,1,Lane,Pune,MH,02,India",
                           "12,2,Way,Delhi,Delhi,03,India"],
    "locations": ["1,Delhi,Delhi,India,1.5,2.5"],
    "products": ["5,Tea,Beverages,2.50,7", ",Ghost,None,1.00,1"],
    "delivery_partners": ["1,Fast,0655,North"],
    "orders": ["100,1,2024-01-03,Delivered,50.00,10", "101,2,2024-01-04,Pending,20.00,12"],
    "order_items": ["1000,100,5,2,2.00", "1001,101,5,1,2.00"],
    "deliveries": ["7,100,2024-01-05,Delivered,1,T7"],
    "returns": ["3,100,5,2024-01-09,Damaged"],
    "payments": ["9,100,2024-01-03,UPI,Completed,50.00"],
}


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{name}.csv")
    with open(path, "w") as out:
        out.write(",".join(ENTITIES[name].columns) + "\n" + "\n".join(lines) + "\n")
    return path


@pytest.fixture
def layers(spark):
    location = scratch_path(spark, "layers")
    made = Layers(spark, "t" + location[-8:] + "_", location)
    made.create()
    yield made
    made.drop_all()


def _all(tmp_path):
    return {name: _write(str(tmp_path), name, lines) for name, lines in FILES.items()}


def test_every_entity_reaches_the_wide_table(layers, tmp_path):
    run_all(layers, _all(tmp_path), RUNS[0])
    counts = {
        name: [
            layers.table(RAW, e.raw_table).count(),
            layers.table(CLEAN, e.clean_table).count(),
            layers.table(CURATED, e.curated_table).count(),
        ]
        for name, e in ENTITIES.items()
    }
    # the product without a key stays in the raw layer
    assert counts.pop("products") == [2, 1, 1]
    assert all(c == [len(FILES[n])] * 3 for n, c in counts.items())
    master = layers.table(CURATED, "master_orders")
    assert sorted(r.customer_city for r in master.collect()) == ["Delhi", "Pune"]
    row = master.first()
    assert (row.order_id, row.return_id, str(row.product_revenue)) == (100, 3, "5.0000")
    for e in ENTITIES.values():
        found = dict(layers.table(CURATED, e.curated_table).dtypes)
        assert found == {f.name: f.dataType.simpleString() for f in e.curated_schema}


def test_loaded_files_are_removed_on_request_only(layers, tmp_path):
    paths = {name: _write(str(tmp_path / name), name, lines) for name, lines in FILES.items()}
    folders = {name: os.path.dirname(path) for name, path in paths.items()}
    run_all(layers, folders, RUNS[0])
    assert all(os.path.exists(path) for path in paths.values())
    paths = {name: _write(str(tmp_path / name), name, lines) for name, lines in FILES.items()}
    for n, path in enumerate(paths.values()):
        os.utime(path, (n, n))  # other files, to the ledger
    for run in RUNS[1:]:  # the second of these finds no files
        run_all(layers, folders, run, LoadOptions(remove_loaded=True))
        assert not any(os.path.exists(path) for path in paths.values())
        for name, e in ENTITIES.items():
            assert layers.table(RAW, e.raw_table).count() == 2 * len(FILES[name]), name
    assert layers.table(CURATED, "master_orders").count() == 2


def test_a_load_that_is_not_published_keeps_its_files(layers, tmp_path, monkeypatch):
    path = _write(str(tmp_path), "orders", FILES["orders"])

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(loads.Landing, "publish", fail)
        with pytest.raises(OSError):
            load_raw(layers, ENTITIES["orders"], path, RUNS[0], LoadOptions(remove_loaded=True))
    assert os.path.exists(path)


def test_files_of_the_whole_path_take_little_disk(spark, tmp_path, monkeypatch):
    """The files that the query makes are packed, and gone before the wide table is built."""
    made = {
        "customer": "1L c_custkey, 'Ann' c_name, 'BUILDING' c_mktsegment, 1 c_nationkey",
        "nation": "1 n_nationkey, 'India' n_name, 1 n_regionkey",
        "region": "1 r_regionkey, 'Asia' r_name",
        "part": "5L p_partkey, 'Tea' p_name, 'SMALL' p_type, 2.5D p_retailprice, 7 p_size",
        "supplier": "1L s_suppkey, 'Fast' s_name, 1 s_nationkey",
        "orders": "100L o_orderkey, 1L o_custkey, timestamp_ntz'2024-01-03' o_orderdate, 'F' o_orderstatus, 5.0D o_totalprice, "
        "'2-HIGH' o_orderpriority",
        "lineitem": "100L l_orderkey, 1 l_linenumber, 5L l_partkey, 1L l_suppkey, 2.0D l_quantity, 2.0D l_extendedprice, "
        "'R' l_returnflag, 'F' l_linestatus, timestamp_ntz'2024-01-05' l_shipdate",
    }
    for name, columns in made.items():
        spark.sql(f"SELECT {columns}").write.parquet(str(tmp_path / f"{name}.parquet"))
    before, after = {}, {}

    def files(paths):
        return {n: [f for f in os.listdir(p) if f.startswith("part-")] for n, p in paths.items()}

    def watched(layers, paths, run_ts, options):
        before.update(files(paths))

        def build(*args, **choices):
            after.update(files(paths))
            return original(*args, **choices)

        original = loads.load_master_orders
        monkeypatch.setattr(loads, "load_master_orders", build)
        run_all(layers, paths, run_ts, options)

    monkeypatch.setattr(registry, "run_all", watched)
    master = registry.load_master_orders(spark, str(tmp_path))
    assert sorted((r.customer_city, r.return_id) for r in master.collect()) == [("Asia", 1001), ("India", 1001)]
    plain = {name for name, found in before.items() if not all(f.endswith(".csv.gz") for f in found)}
    assert plain == {"customer_addresses"} and all(before.values())
    assert set(after) == set(before) and not any(after.values())


def test_default_paths(tmp_path):
    paths = loads.default_paths(str(tmp_path))
    assert sorted(paths) == sorted(ENTITIES) and paths["orders"].endswith("/orders.csv")


def _customers(layers, tmp_path, lines, run, **options):
    path = _write(str(tmp_path / run[:10]), "customers", lines)
    run_entity(layers, ENTITIES["customers"], path, run, LoadOptions(**options))


CHANGED = ["1,Ann,Female,a@x,1990-01-01,0999,2020-01-01", "3,Cy,Male,c@x,1992-01-01,07,2021-01-01"]


@pytest.mark.parametrize("options", [{}, {"since": RUNS[1]}], ids=["whole", "incremental"])
def test_second_load_versions_the_changed_customer(layers, tmp_path, options):
    _customers(layers, tmp_path, FILES["customers"], RUNS[0])
    _customers(layers, tmp_path, CHANGED, RUNS[1], **options)
    dim = layers.table(CURATED, "dim_customers").select(
        "customer_id", "phone_number", "is_current", "effective_end_date"
    )
    found = [(k, p, c, str(e)) for k, p, c, e in rows(dim)]
    assert found == [
        (1, "0123", False, RUNS[1]),
        (1, "0999", True, "None"),
        (2, "0456", True, "None"),
        (3, "07", True, "None"),
    ]
    clean = layers.table(CLEAN, "clean_customers").select("customer_id", "phone_number", "is_active")
    assert rows(clean) == [(1, "0999", "yes"), (2, "0456", "yes"), (3, "07", "yes")]


def test_two_step_versions(layers, tmp_path):
    for run, lines in zip(RUNS, [FILES["customers"], CHANGED, CHANGED]):
        _customers(layers, tmp_path, lines, run, two_step_versions=True)
        dim = layers.table(CURATED, "dim_customers").filter("customer_id = 1")
        if run == RUNS[1]:
            assert [r.is_current for r in dim.collect()] == [False]
    starts = sorted((str(r.effective_start_date), r.is_current) for r in dim.collect())
    assert starts == [(RUNS[0], False), (RUNS[2], True)]


def test_facts_load_once_or_twice(layers, tmp_path):
    entity, path = ENTITIES["orders"], _write(str(tmp_path), "orders", FILES["orders"])
    for run in RUNS[:2]:
        run_entity(layers, entity, path, run)
    assert layers.table(CURATED, "fact_orders").count() == 2
    run_entity(layers, entity, path, RUNS[2], LoadOptions(repeat_facts=True))
    assert layers.table(CURATED, "fact_orders").count() == 4


ORDER_LOADS = [
    FILES["orders"],
    ["101,2,2024-01-04,Delivered,20.00,12", "102,1,2024-02-04,Pending,5.00,10"],
    ["102,1,2024-02-04,Delivered,5.00,10"],
]


@pytest.mark.parametrize("log_facts", [False, True], ids=["replaced", "log"])
@pytest.mark.parametrize("incremental", [False, True], ids=["whole", "incremental"])
def test_facts_over_three_loads(layers, tmp_path, log_facts, incremental):
    entity = ENTITIES["orders"]
    for run, lines in zip(RUNS, ORDER_LOADS):
        path = _write(str(tmp_path / run[:10]), "orders", lines)
        options = LoadOptions(log_facts=log_facts, since=run if incremental else None)
        run_entity(layers, entity, path, run, options)
    clean = layers.table(CLEAN, entity.clean_table)
    assert clean.columns == entity.clean_schema.names
    # the latest status in the clean layer, the first one in the curated layer
    assert rows(clean.select("order_id", "order_status")) == [
        (100, "Delivered"), (101, "Delivered"), (102, "Delivered"),
    ]
    fact = layers.table(CURATED, entity.curated_table).select("order_id", "order_status")
    assert rows(fact) == [(100, "Delivered"), (101, "Pending"), (102, "Pending")]
    layers.drop(CLEAN, entity.clean_table)
    assert not layers.exists(CLEAN, entity.clean_table)


def test_changes_of_a_log_are_found_by_the_scan(layers, tmp_path):
    entity, options = ENTITIES["orders"], LoadOptions(log_facts=True)
    path = _write(str(tmp_path), "orders", FILES["orders"])
    load_raw(layers, entity, path, RUNS[0])
    load_clean(layers, entity, RUNS[0], options)
    since = F.lit(RUNS[1]).cast("timestamp_ntz")
    changes = layers.changes(CLEAN, entity.clean_table, "last_updated_ts", since)
    text = plan(changes)
    assert "GreaterThanOrEqual(last_updated_ts" in text and "Window" not in text
    assert "WindowGroupLimit" in plan(layers.table(CLEAN, entity.clean_table))


def test_returns_are_repeated_on_request_only(layers, tmp_path):
    path = _write(str(tmp_path), "returns", FILES["returns"])
    for run in RUNS[:2]:
        run_entity(layers, ENTITIES["returns"], path, run)
    assert layers.table(CURATED, "fact_returns").count() == 1
    run_entity(layers, ENTITIES["returns"], path, RUNS[1], LoadOptions(repeat_facts=True))
    assert layers.table(CURATED, "fact_returns").count() == 2


def test_only_new_and_changed_files_are_loaded(layers, tmp_path):
    entity, folder = ENTITIES["delivery_partners"], tmp_path / "in"
    counts = []
    for n, lines in enumerate([["1,A,01,N"], ["2,B,02,S"], [], ["1,A,09,N"]]):
        if lines:
            path = _write(str(folder), entity.name, lines)
            # the last file replaces the first one
            target = folder / ("0.csv" if n in (0, 3) else "1.csv")
            os.replace(path, target)
            os.utime(target, (n, n))
        load_raw(layers, entity, str(folder), RUNS[0])
        counts.append(layers.table(RAW, entity.raw_table).count())
    assert counts == [1, 2, 2, 3]
    load_raw(layers, entity, str(folder), RUNS[1], LoadOptions(skip_loaded=False))
    assert layers.table(RAW, entity.raw_table).count() == 5
    load_clean(layers, entity, RUNS[1])
    found = layers.table(CLEAN, entity.clean_table).select("partner_name", "contact_number")
    assert rows(found) == [("A", "09"), ("B", "02")]


@pytest.mark.parametrize("log_facts", [False, True])
def test_incremental_load_of_nothing(layers, tmp_path, log_facts):
    for name in ("orders", "customers", "returns"):
        path = _write(str(tmp_path), name, FILES[name])
        options = LoadOptions(log_facts=log_facts)
        run_entity(layers, ENTITIES[name], path, RUNS[0], options)
        before = rows(layers.table(CURATED, ENTITIES[name].curated_table))
        options = LoadOptions(log_facts=log_facts, since=RUNS[1])
        run_entity(layers, ENTITIES[name], path, RUNS[1], options)
        assert rows(layers.table(CURATED, ENTITIES[name].curated_table)) == before
        clean = layers.table(CLEAN, ENTITIES[name].clean_table)
        assert clean.count() == len(FILES[name])


def test_null_in_a_required_column_aborts(layers, tmp_path):
    entity = ENTITIES["customers"]
    path = _write(str(tmp_path), "customers", ["1,Ann,,a@x,1990-01-01,01,2020-01-01"])
    with pytest.raises(Exception, match="NULL in required column gender"):
        run_entity(layers, entity, path, RUNS[0])
    assert not layers.exists(CLEAN, entity.clean_table)
    # nullable until the curated layer
    entity, path = ENTITIES["returns"], _write(str(tmp_path), "returns", ["3,100,5,2024-01-09,"])
    load_raw(layers, entity, path, RUNS[0])
    load_clean(layers, entity, RUNS[0])
    with pytest.raises(Exception, match="NULL in required column return_reason"):
        loads.load_curated(layers, entity, RUNS[0])
    loads.load_curated(layers, entity, RUNS[0], LoadOptions(enforce_required=False))
    assert layers.table(CURATED, "fact_returns").count() == 1


def test_addresses_merged_by_customer_are_ambiguous_on_the_second_load(layers, tmp_path):
    entity = ENTITIES["customer_addresses"]
    path = _write(str(tmp_path), entity.name, FILES[entity.name])
    load_raw(layers, entity, path, RUNS[0])
    load_clean(layers, entity, RUNS[0], merge_key=["customer_id"])
    assert layers.table(CLEAN, entity.clean_table).count() == 3
    with pytest.raises(Exception, match="ambiguous merge"):
        load_clean(layers, entity, RUNS[1], merge_key=["customer_id"])
    load_clean(layers, entity, RUNS[1])
    assert layers.table(CLEAN, entity.clean_table).count() == 3


def test_keys_written_differently_are_one_key(layers, tmp_path):
    lines = ["1,Tea,Beverages,2.50,7", "01,Tea,Beverages,2.50,7"]
    path = _write(str(tmp_path), "products", lines)
    run_entity(layers, ENTITIES["products"], path, RUNS[0])
    assert layers.table(CURATED, "dim_products").count() == 1


def test_tables_and_versions(spark, layers):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    layers.create_table(COMMON, "t", df.schema)
    layers.create_table(COMMON, "t", df.schema)
    layers.append(COMMON, "t", df)
    layers.append(COMMON, "t", df)
    assert layers.table(COMMON, "t").count() == 2
    layers.drop(COMMON, "t")
    layers.drop(COMMON, "t")
    assert not layers.exists(COMMON, "t")
    for n in range(4):
        before = layers.table_or_empty(COMMON, "r", df.schema)
        layers.replace(COMMON, "r", before.unionByName(df))
    assert layers.table(COMMON, "r").count() == 4
    assert layers.versions(COMMON, "r") == [2, 3]
    # a repeated write of the same version changes nothing
    previous = spark.table(layers.version_name(COMMON, "r", 2))
    layers.replace(COMMON, "r", previous.unionByName(df), version=3)
    assert layers.table(COMMON, "r").count() == 4
    layers.drop(COMMON, "r")
    assert layers.versions(COMMON, "r") == []


@pytest.mark.skipif("RETAIL_CSV_DIR" not in os.environ, reason="needs the sample CSV files")
def test_sample_files(layers):
    """Known totals of the sample files, which hold no deliveries."""
    paths = loads.default_paths(os.environ["RETAIL_CSV_DIR"])
    run_all(layers, {n: p for n, p in paths.items() if os.path.exists(p)}, RUNS[0])
    orders = layers.table(CURATED, "fact_orders")
    delivered = orders.filter("order_status = 'Delivered'")
    total = "sum(total_value)"
    assert str(orders.agg({"total_value": "sum"}).first()[total]) == "5014494.70"
    assert str(delivered.agg({"total_value": "sum"}).first()[total]) == "1117433.75"
    assert delivered.select("customer_id").distinct().count() == 70
