import os

from helpers import rows
from pyspark.sql import functions as F

from tiermart.plans.loads import LoadOptions, run_entity
from tiermart.schemas import ENTITIES
from tiermart.session import scratch_path
from tiermart.sources.csv import write_csv
from tiermart.sources.tables import CLEAN, COMMON, CURATED, Layers
from tiermart.streaming.ingest import BATCHES, ingest_available, raw_stream, upsert_available

ENTITY = ENTITIES["delivery_partners"]
FIRST = [("1", "Fast", "01", "North"), ("2", "Slow", "02", "South")]
SECOND = [("2", "Slow", "99", "South"), ("3", "New", "03", "West")]
RUNS = ["2024-01-01 00:00:00", "2024-02-01 00:00:00"]


def _files(spark, data, path, mode="append"):
    write_csv(spark.createDataFrame(data, ENTITY.source_schema).coalesce(1), path, mode)


def _layers(spark, name):
    location = scratch_path(spark, name)
    layers = Layers(spark, name + location[-8:] + "_", location)
    layers.create()
    return layers


def test_files_are_ingested_once(spark):
    folder, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for data in (FIRST, SECOND):
        _files(spark, data, folder)
        for _ in range(2):  # the second run finds nothing new
            stream = raw_stream(spark, folder, ENTITY)
            ingest_available(stream, out, out + "-c").awaitTermination(120)
    raw = spark.read.parquet(out)
    assert raw.columns == ENTITY.raw_schema.names
    assert rows(raw.select(*ENTITY.columns)) == sorted(FIRST + SECOND, key=repr)
    assert raw.filter(F.length("_stg_file_md5") == 32).count() == 4


def test_micro_batches_equal_the_batch_load(spark):
    streamed, batch = _layers(spark, "s"), _layers(spark, "b")
    folder, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "c")
    for data, run in zip((FIRST, SECOND), RUNS):
        _files(spark, data, folder)
        stream = raw_stream(spark, folder, ENTITY, run)
        upsert_available(stream, streamed, ENTITY, checkpoint, run, True).awaitTermination(120)
        alone = scratch_path(spark, "alone")
        _files(spark, data, alone)
        run_entity(batch, ENTITY, alone, run, LoadOptions(since=run))
    for layer, table in ((CLEAN, ENTITY.clean_table), (CURATED, ENTITY.curated_table)):
        a, b = streamed.table(layer, table), batch.table(layer, table)
        keep = [c for c in a.columns if not c.startswith("_stg")]
        assert rows(a.select(*keep)) == rows(b.select(*keep))
    assert streamed.table(CURATED, ENTITY.curated_table).count() == 4


def test_several_batches_in_one_run(spark):
    layers = _layers(spark, "m")
    folder = scratch_path(spark, "in")
    for data in (FIRST, SECOND):
        _files(spark, data, folder)
    stream = raw_stream(spark, folder, ENTITY, RUNS[0], max_files_per_trigger=1)
    query = upsert_available(stream, layers, ENTITY, scratch_path(spark, "c"), RUNS[0])
    query.awaitTermination(120)
    assert query.lastProgress["batchId"] == 1
    clean = layers.table(CLEAN, ENTITY.clean_table).select(*ENTITY.columns)
    assert rows(clean) == [(1, "Fast", "01", "North"), (2, "Slow", "99", "South"), (3, "New", "03", "West")]


def _stream(spark, layers, folder, checkpoint, run, versions=True):
    stream = raw_stream(spark, folder, ENTITY, run)
    upsert_available(stream, layers, ENTITY, checkpoint, run, versions).awaitTermination(120)


def _state(layers):
    clean = rows(layers.table(CLEAN, ENTITY.clean_table).select(*ENTITY.columns))
    return clean, rows(layers.table(CURATED, ENTITY.curated_table).filter("is_current").select(*ENTITY.columns))


def test_repeated_batch_gives_the_same_table(spark):
    """A batch of one query that is run again, before and after its record was written."""
    layers = _layers(spark, "r")
    folder, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "c")
    _files(spark, FIRST, folder)
    _stream(spark, layers, folder, checkpoint, RUNS[0])
    _files(spark, SECOND, folder)
    _stream(spark, layers, folder, checkpoint, RUNS[1])
    done, want = layers.table(COMMON, f"{ENTITY.clean_table}_batches"), _state(layers)
    assert sorted((r.batch_id, r.version) for r in done.collect()) == [(0, 0), (1, 1)]
    versions = layers.table(CURATED, ENTITY.curated_table).count()
    for lost in (False, True):
        for name in ("1", ".1.crc"):  # as if the driver had died before the commit
            os.remove(os.path.join(checkpoint, "commits", name))
        if lost:
            kept = [tuple(r) for r in done.filter("batch_id = 0").collect()]
            layers.drop(COMMON, f"{ENTITY.clean_table}_batches")
            layers.append(COMMON, f"{ENTITY.clean_table}_batches", spark.createDataFrame(kept, BATCHES))
        _stream(spark, layers, folder, checkpoint, RUNS[1])
        assert _state(layers) == want
        assert layers.table(CURATED, ENTITY.curated_table).count() == versions


def test_streams_and_batch_loads_share_a_table(spark):
    layers = _layers(spark, "x")
    folder, alone = scratch_path(spark, "in"), scratch_path(spark, "alone")
    _files(spark, [("7", "Old", "07", "East")], alone)
    run_entity(layers, ENTITY, alone, RUNS[0])
    for n, data in enumerate((FIRST, SECOND)):
        _files(spark, data, folder)
        _stream(spark, layers, folder, scratch_path(spark, "c") if n else folder + "-c", RUNS[0])
        more = scratch_path(spark, "more")
        _files(spark, [(str(8 + n), "Batch", "08", "East")], more)
        run_entity(layers, ENTITY, more, RUNS[1], LoadOptions(since=RUNS[1]))
    want = [(1, "Fast", "01", "North"), (2, "Slow", "99", "South"), (3, "New", "03", "West"), (7, "Old", "07", "East")]
    want += [(8, "Batch", "08", "East"), (9, "Batch", "08", "East")]
    assert _state(layers) == (want, want)


def test_older_file_in_a_later_batch_changes_nothing(spark):
    layers = _layers(spark, "o")
    old, new = scratch_path(spark, "old"), scratch_path(spark, "new")
    _files(spark, [("2", "Slow", "02", "South"), ("5", "Five", "05", "South")], old)
    _files(spark, SECOND, new)
    for folder, run in ((new, RUNS[0]), (old, RUNS[1])):
        _stream(spark, layers, folder, scratch_path(spark, "c"), run)
    want = [(2, "Slow", "99", "South"), (3, "New", "03", "West"), (5, "Five", "05", "South")]
    assert _state(layers) == (want, want)
    assert layers.table(CURATED, ENTITY.curated_table).count() == 3
