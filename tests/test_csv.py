import gzip
import os

import pytest
from helpers import rows

from tiermart.schemas import AUDIT_COLUMNS, ENTITIES
from tiermart.sources.csv import (
    read_or_quarantine,
    read_raw,
    scan_csv,
    scan_typed,
    with_audit,
    write_csv,
)
from tiermart.sources.files import content_keys, list_files

ADDRESSES = ENTITIES["customer_addresses"]
ORDERS = ENTITIES["orders"]
ADDRESS_HEAD = "address_id,customer_id,address,city,state,zip_code,country\n"
ORDER_HEAD = "order_id,customer_id,order_date,order_status,total_value,address_id\n"


def _file(tmp_path, text, name="data.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def test_quotes_line_breaks_and_leading_zeros(spark, tmp_path):
    path = _file(
        tmp_path, ADDRESS_HEAD + '1,2,"12, ""Main"" Road\nBlock 3",Delhi,Delhi,007,India'
    )
    assert rows(scan_csv(spark, path, ADDRESSES)) == [
        ("1", "2", '12, "Main" Road\nBlock 3', "Delhi", "Delhi", "007", "India")
    ]


def test_null_tokens(spark, tmp_path):
    path = _file(tmp_path, ADDRESS_HEAD + '1,NULL,null,\\N,,"",nullable\n')
    assert rows(scan_csv(spark, path, ADDRESSES)) == [
        ("1", None, None, None, None, "", "nullable")
    ]


def test_columns_bind_by_position(spark, tmp_path):
    path = _file(tmp_path, "a,b,c,d,e,f\n1,2,2024-01-01,Shipped,5.00,9\n")
    assert scan_csv(spark, path, ORDERS).columns == ORDERS.columns


@pytest.mark.parametrize("line", ["1,2,2024-01-01", "1,2,2024-01-01,Shipped,5.00,9,surplus"])
@pytest.mark.parametrize("entity", ["orders", "returns"])
def test_ragged_line_aborts_even_for_one_column(spark, tmp_path, line, entity):
    entity = ENTITIES[entity]
    if len(entity.columns) == 5:
        line = line.replace(",surplus", "")
    path = _file(tmp_path, ",".join(entity.columns) + "\n" + line + "\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        scan_csv(spark, path, entity).select(entity.columns[0]).collect()


def test_line_break_in_a_file_declared_single_line_aborts(spark, tmp_path):
    path = _file(tmp_path, ORDER_HEAD + '1,2,2024-01-01,"Ship\nped",5.00,9\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        scan_csv(spark, path, ORDERS).collect()


def test_quarantine_keeps_the_line(spark, tmp_path):
    path = _file(tmp_path, ORDER_HEAD + "1,2,2024-01-01,Shipped,5.00,9\n2,3,short\n")
    good, bad = read_or_quarantine(spark, path, ORDERS)
    assert rows(good.select(*ORDERS.columns)) == [("1", "2", "2024-01-01", "Shipped", "5.00", "9")]
    assert [r[0] for r in rows(bad.select("_corrupt_record"))] == ["2,3,short"]


def test_inline_cast(spark, tmp_path):
    path = _file(tmp_path, ",".join(ENTITIES["returns"].columns) + "\n1,2,3,2024-05-06,Damaged\n")
    row = scan_typed(spark, path, ENTITIES["returns"], ["return_date"]).first()
    assert str(row.return_date) == "2024-05-06" and row.return_id == "1"


def test_compressed_file(spark, tmp_path):
    path = tmp_path / "orders.csv.gz"
    with gzip.open(path, "wb") as out:
        out.write((ORDER_HEAD + "1,2,2024-01-01,Shipped,5.00,9\n").encode())
    assert scan_csv(spark, str(path), ORDERS).count() == 1


def test_audit_columns(spark, tmp_path):
    for name in ("a.csv", "b.csv", "c.csv"):
        text = "same" if name != "c.csv" else "other"
        _file(tmp_path, ORDER_HEAD + f"1,2,2024-01-01,{text},5.00,9\n", name)
        os.utime(tmp_path / name, (0, 0))
    scan = scan_csv(spark, str(tmp_path), ORDERS)
    raw = with_audit(
        spark,
        scan,
        str(tmp_path),
        ORDERS,
        "2024-01-01 10:00:00",
    )
    assert raw.dtypes == [(f.name, f.dataType.simpleString()) for f in ORDERS.raw_schema]
    found = {os.path.basename(r._stg_file_name): r for r in raw.collect()}
    assert sorted(found) == ["a.csv", "b.csv", "c.csv"]
    # equal content, equal key
    assert found["a.csv"]._stg_file_md5 == found["b.csv"]._stg_file_md5
    assert found["a.csv"]._stg_file_md5 != found["c.csv"]._stg_file_md5
    # file time of 1970-01-01 00:00 UTC in the zone of the warehouse
    assert str(found["a.csv"]._stg_file_load_ts) == "1970-01-01 05:30:00"
    assert str(found["a.csv"]._copy_data_ts) == "2024-01-01 10:00:00"


def test_audit_without_reading_content(spark, tmp_path):
    path = _file(tmp_path, ORDER_HEAD + "1,2,2024-01-01,Shipped,5.00,9\n")
    raw = read_raw(spark, path, ORDERS, hash_content=False)
    assert raw.columns == ORDERS.columns + AUDIT_COLUMNS
    assert len(raw.first()._stg_file_md5) == 32


def test_content_keys_follow_the_lines(spark, tmp_path):
    texts = {"a": "x\ny\n", "b": "y\nx", "c": "x\r\ny\r\n", "d": "x\nx\n", "e": "x\n", "f": "", "g": "y\ny\n"}
    for name, text in texts.items():
        _file(tmp_path, text, name)
    found = {os.path.basename(r.file_name): r.content_key for r in content_keys(spark, str(tmp_path)).collect()}
    assert "f" not in found and len(set(found.values())) == len(found) == 6  # also by order and line ends
    _file(tmp_path, texts["a"], "h")
    again = {os.path.basename(r.file_name): r.content_key for r in content_keys(spark, str(tmp_path)).collect()}
    assert again["h"] == again["a"] == found["a"]


def test_content_keys_do_not_depend_on_blocks(spark, tmp_path, conf):
    lines = [f"line {i % 17} of {i}" for i in range(400)]
    swapped = [*lines[:390], lines[395], *lines[391:395], lines[390], *lines[396:]]
    for name, of in (("a", lines), ("b", swapped), ("c", lines[::-1])):
        _file(tmp_path, "\n".join(of) + "\n", name)
    found = []
    for size in (10**6, 700, 64):
        conf(files__maxPartitionBytes=size, files__openCostInBytes=0)
        found.append({os.path.basename(r.file_name): r.content_key for r in content_keys(spark, str(tmp_path)).collect()})
    assert found[0] == found[1] == found[2] and len(set(found[0].values())) == 3


def test_listing(spark, tmp_path):
    _file(tmp_path, "12345", "a.csv")
    _file(tmp_path, "1", "b.txt")
    listed = list_files(spark, str(tmp_path), "*.csv").collect()
    assert [(os.path.basename(r.file_name), r.file_size) for r in listed] == [("a.csv", 5)]


def test_written_file_reads_back(spark, tmp_path):
    schema = ADDRESSES.source_schema
    data = [("1", "2", 'a "b"\nc', "", None, "007", "x,y")]
    path = str(tmp_path / "out")
    write_csv(spark.createDataFrame(data, schema), path)
    assert rows(scan_csv(spark, path, ADDRESSES)) == data


@pytest.mark.parametrize("entity", [ORDERS, ADDRESSES], ids=["orders", "addresses"])
def test_files_written_with_gzip_read_back(spark, tmp_path, entity):
    width = len(entity.columns)
    data = [(str(i), *["x,y"] * (width - 3), None, "") for i in range(20)]
    made = spark.createDataFrame(data, entity.source_schema).coalesce(2)
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    write_csv(made, plain)
    write_csv(made, packed, compression="gzip")
    listed = [os.path.basename(r.file_name) for r in list_files(spark, packed).collect() if r.file_size]
    assert listed and all(name.endswith(".csv.gz") for name in listed)
    found = [read_raw(spark, path, entity, "2024-01-01 00:00:00") for path in (plain, packed)]
    assert rows(found[1].select(*entity.columns)) == rows(found[0].select(*entity.columns)) == sorted(data, key=repr)
    assert found[1].where("_stg_file_md5 IS NULL").isEmpty()


@pytest.mark.parametrize("name", ["orders", "customer_addresses"])
def test_files_are_not_read_for_hot_names_if_the_keys_are_broadcast(spark, tmp_path, monkeypatch, name):
    def never(*_):
        raise AssertionError("the files were read once more")

    monkeypatch.setattr("tiermart.operators.skew.find_cells", never)
    entity = ENTITIES[name]
    path = tmp_path / "one.csv"
    lines = [",".join(entity.columns), *(",".join([str(i)] * len(entity.columns)) for i in range(5))]
    path.write_text("\n".join(lines) + "\n")
    found = read_raw(spark, str(path), entity, "2024-01-01 00:00:00")
    assert found.columns == [*entity.columns, *AUDIT_COLUMNS]
    assert found.where("_stg_file_md5 IS NOT NULL").count() == 5
