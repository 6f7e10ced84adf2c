"""From files to the curated layer, one entity at a time or all of them."""

from __future__ import annotations

import math
import os
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.functions import run_timestamp
from tiermart.functions.columns import RunTs
from tiermart.operators.conform import conform, conform_entity
from tiermart.operators.dedupe import dedupe_latest
from tiermart.operators.merge import new_rows, scd1_upsert, scd2_apply, scd2_pass, stamped
from tiermart.operators.quality import require_not_null
from tiermart.operators.skew import estimated_bytes
from tiermart.plans.refresh import MASTER, refresh_master_orders
from tiermart.plans.wide import DIMENSIONS, FACTS, build_master_orders
from tiermart.schemas import AUDIT_COLUMNS, ENTITIES, IS_CURRENT, LOAD_TS, UPDATED_TS, Entity
from tiermart.sources.csv import read_raw
from tiermart.sources.files import list_files, remove_files
from tiermart.sources.landing import FILE_FIELDS, Landing
from tiermart.sources.segments import Segments
from tiermart.sources.tables import CLEAN, CURATED, RAW, Layers

# the row of the newer file, then of the later copy, is the newer one
NEWER_BY = [LOAD_TS, "_copy_data_ts"]
# new files that one load takes; more are loaded in turn
FILES = 10_000
# bytes of stored facts that the wide table joins at a time, and most parts of its orders
PART_BYTES, PARTS = 1 << 30, 8


@dataclass(frozen=True)
class LoadOptions:
    """Choices of a run.

    two_step_versions: close changed versions in one run and open their
    successors in the next, as a single merge statement does; otherwise both
    happen in the same run.
    null_safe: treat a change to or from NULL as a change.
    repeat_facts: load insert-only facts a second time by plain append, which
    doubles every row.
    skip_loaded: files that the raw table holds already (same name, size and
    modification time) are not loaded again.
    enforce_required: a NULL in a column declared NOT NULL aborts the load.
    buckets: hash buckets of replaced tables; 0 leaves them unbucketed.
    rewrite_buckets: replaced tables are kept in so many buckets, of which a load writes only those that its
    rows fall into, and closed versions of dimensions are appended once and never read or written
    by a load again; the wide table is brought up to date by the orders that changed; 0 writes whole tables.
    Pays for incremental loads.
    log_facts: clean tables of facts are logs: a load appends its rows, and a view
    shows the latest row per key. Loads then rewrite nothing; readers pay one
    shuffle by key. To be chosen before the first load of a table.
    since: an incremental load: only raw rows copied, and clean rows updated, at
    or after this time feed the next layer; the default reads everything.
    hash_content: audit files by their content, which reads them twice.
    remove_loaded: new files are removed once their rows are published in the raw table, so that they take no
    disk while the other layers are loaded; for files that were made for this load only.
    parallel: entities loaded at the same time; they are independent up to the
    wide table.
    """

    two_step_versions: bool = False
    null_safe: bool = False
    repeat_facts: bool = False
    skip_loaded: bool = True
    enforce_required: bool = True
    buckets: int = 0
    rewrite_buckets: int = 0
    log_facts: bool = False
    since: str | None = None
    hash_content: bool = True
    remove_loaded: bool = False
    parallel: int = 4

    @property
    def incremental(self) -> bool:
        return self.since is not None


def clean_source(raw: DataFrame, entity: Entity) -> DataFrame:
    """Latest raw row per key, typed.

    The key is typed first: the rows are then already placed by the typed key
    when the merge joins on it. Equal load times fall back to the copy time and
    then to all attributes.
    """
    kinds = dict(entity.fields)
    keyed = conform(raw, [(k, kinds[k]) for k in entity.key])
    order = [
        F.desc_nulls_last(LOAD_TS),
        F.desc_nulls_last("_copy_data_ts"),
        F.asc_nulls_last("_stg_file_name"),
        *[F.desc_nulls_last(c) for c in entity.columns if c not in entity.key],
        F.desc_nulls_last("_stg_file_md5"),
    ]
    latest = dedupe_latest(keyed, entity.key, order, entity.drop_null_keys, tie_break=False)
    return conform_entity(latest, entity).select(*entity.typed_columns, *AUDIT_COLUMNS)


def load_raw(
    layers: Layers,
    entity: Entity,
    path: str | list[str],
    run_ts: RunTs = None,
    options: LoadOptions = LoadOptions(),
) -> None:
    """Append the files to the raw table.

    Rows land first and are published with the names of their files after, in one step: a load that fails
    in between leaves nothing that readers or the next load can see. Very many new files are
    loaded in groups, each published on its own.
    """
    spark = layers.spark
    raw = Landing(layers, RAW, entity.raw_table, entity.raw_schema)
    raw.create()
    now = run_timestamp(run_ts)
    if not options.skip_loaded:
        load_id = raw.land(read_raw(spark, path, entity, run_ts, options.hash_content))
        # no file is named, so that a later load does not take them for loaded
        unnamed = [F.lit(None).cast(kind).alias(name) for name, kind in FILE_FIELDS]
        raw.publish(load_id, spark.range(1).select(*unnamed, now.alias("loaded_at")))
        return
    while True:
        files = list_files(spark, path)
        new = files.join(raw.files(), files.columns, "left_anti").select(*files.columns)
        found = new.orderBy("last_modified", "file_name").limit(FILES).collect()  # names only
        if found:
            names = [row.file_name for row in found]
            load_id = raw.land(read_raw(spark, names, entity, run_ts, options.hash_content))
            loaded = spark.createDataFrame(found, new.schema)
            raw.publish(load_id, loaded.withColumn("loaded_at", now))
            if options.remove_loaded:
                remove_files(spark, names)
        if len(found) < FILES:
            return


def clean_segments(
    layers: Layers, entity: Entity, buckets: int, keys: Sequence[str] | None = None
) -> Segments:
    return Segments(
        layers, CLEAN, entity.clean_table, entity.clean_schema, keys or entity.key, buckets
    )


def version_segments(layers: Layers, entity: Entity, buckets: int) -> Segments:
    """Current versions in buckets, closed ones apart."""
    table, schema = entity.curated_table, entity.curated_schema
    return Segments(
        layers, CURATED, table, schema, entity.version_key, buckets, final=f"NOT coalesce({IS_CURRENT}, false)"
    )


def load_clean(
    layers: Layers,
    entity: Entity,
    run_ts: RunTs = None,
    options: LoadOptions = LoadOptions(),
    merge_key: Sequence[str] | None = None,
) -> None:
    """Upsert the latest raw rows into the clean table.

    Another `merge_key` than the entity key may match several source rows to
    one target row, which raises; columns of the entity key then keep the
    value of the target.
    """
    raw = layers.table(RAW, entity.raw_table)
    if options.incremental:
        raw = raw.filter(F.col("_copy_data_ts") >= run_timestamp(options.since))
    source = clean_source(raw, entity)
    if options.enforce_required:
        source = require_not_null(source, entity.required_columns)
    if options.log_facts and not entity.is_dimension:
        rows = source.withColumn(UPDATED_TS, run_timestamp(run_ts))
        rows = rows.select(*entity.clean_schema.names)
        layers.append_latest(
            CLEAN, entity.clean_table, rows, entity.key, [*NEWER_BY, UPDATED_TS]
        )
        return
    keys = list(merge_key or entity.key)
    skip = {*keys, *entity.key}
    if options.incremental or options.rewrite_buckets:
        source = layers.stage(f"load_{entity.clean_table}", source)
    if options.rewrite_buckets:
        held = clean_segments(layers, entity, options.rewrite_buckets, keys)
        touched = held.touched(source)
        target = held.open_rows(touched)
    else:
        target = layers.table_or_empty(CLEAN, entity.clean_table, entity.clean_schema)
    merged = scd1_upsert(
        target,
        source,
        keys,
        set_columns=[c for c in entity.typed_columns + AUDIT_COLUMNS if c not in skip],
        run_ts=run_ts,
        source_unique=keys == entity.key,
        incremental=options.incremental,
        newer_by=NEWER_BY,
    )
    if options.rewrite_buckets:
        held.rewrite(merged, touched)
        return
    layers.replace(
        CLEAN, entity.clean_table, merged, bucket_by=keys, buckets=options.buckets
    )


def load_curated(
    layers: Layers,
    entity: Entity,
    run_ts: RunTs = None,
    options: LoadOptions = LoadOptions(),
) -> None:
    """Feed the curated table: versions for dimensions, new rows for facts."""
    if options.incremental:
        since = run_timestamp(options.since)
        source = layers.changes(CLEAN, entity.clean_table, UPDATED_TS, since)
        # several loads since then may have written the same key
        source = dedupe_latest(source, entity.key, [*NEWER_BY, UPDATED_TS])
    else:
        source = layers.table(CLEAN, entity.clean_table)
    source = source.select(*entity.typed_columns, UPDATED_TS)
    if options.enforce_required and entity.nullable:
        # nullable in the clean layer, required here
        source = require_not_null(source, entity.typed_columns)
    if options.incremental or (options.rewrite_buckets and entity.is_dimension):
        source = layers.stage(f"load_{entity.curated_table}", source)
    table = entity.curated_table
    if entity.curate == "versioned":
        if options.rewrite_buckets:
            held = version_segments(layers, entity, options.rewrite_buckets)
            touched = held.touched(source)
            dim = held.open_rows(touched)
        else:
            dim = layers.table_or_empty(CURATED, table, entity.curated_schema)
        merge = scd2_pass if options.two_step_versions else scd2_apply
        state = merge(
            dim,
            source,
            entity.version_key,
            entity.tracked,
            run_ts,
            null_safe=options.null_safe,
            # the clean table holds one row per entity key
            source_unique=set(entity.key) <= set(entity.version_key),
            incremental=options.incremental,
        )
        if options.rewrite_buckets:
            held.rewrite(state, touched)
            return
        layers.replace(
            CURATED, table, state, bucket_by=entity.version_key, buckets=options.buckets
        )
        return
    layers.create_table(CURATED, table, entity.curated_schema)
    target = layers.table(CURATED, table)
    rows = new_rows(target, source, entity.key, run_ts, True, options.incremental)
    layers.append(CURATED, table, rows)
    if options.repeat_facts:
        layers.append(CURATED, table, stamped(source, target.columns, run_ts))


def run_entity(
    layers: Layers,
    entity: Entity,
    path: str | list[str],
    run_ts: RunTs = None,
    options: LoadOptions = LoadOptions(),
) -> None:
    """Files to raw, raw to clean, clean to curated."""
    load_raw(layers, entity, path, run_ts, options)
    load_clean(layers, entity, run_ts, options)
    load_curated(layers, entity, run_ts, options)


def curated_tables(layers: Layers) -> dict[str, DataFrame]:
    return {
        name: layers.table(CURATED, ENTITIES[name].curated_table)
        for name in DIMENSIONS + FACTS
    }


def _master_parts(tables: Mapping[str, DataFrame]) -> list[dict[str, DataFrame]]:
    """The tables, once for each part of the orders; every fact is in one part."""
    parts = min(math.ceil(sum(estimated_bytes(tables[name]) for name in FACTS) / PART_BYTES), PARTS)
    if parts <= 1:
        return [dict(tables)]
    part = F.pmod(F.xxhash64("order_id"), F.lit(parts))
    return [{**tables, **{name: tables[name].filter(part == n) for name in FACTS}} for n in range(parts)]


def load_master_orders(
    layers: Layers, run_ts: RunTs = None, rewrite_buckets: int = 0, **choices
) -> DataFrame:
    """Build the wide table, so that reports need no join; by buckets, only what has changed is built again.

    Large facts are joined in parts of the orders: each part reads the tables once more, and the shuffles of
    one part only are on disk at a time.
    """
    tables = curated_tables(layers)
    if rewrite_buckets:
        refresh_master_orders(layers, tables, run_ts, rewrite_buckets, **choices)
        return layers.table(CURATED, MASTER)
    parts = _master_parts(tables)
    if len(parts) > 1:  # all of them get the same time
        run_ts = layers.spark.range(1).select(run_timestamp(run_ts)).first()[0]
    first, *others = parts
    layers.replace(
        CURATED,
        MASTER,
        build_master_orders(first, run_ts, **choices),
        further=(build_master_orders(part, run_ts, **choices) for part in others),
    )
    return layers.table(CURATED, MASTER)


def run_all(
    layers: Layers,
    paths: Mapping[str, str | list[str]],
    run_ts: RunTs = None,
    options: LoadOptions = LoadOptions(),
) -> None:
    """Every entity that has files, then the wide table."""
    layers.create()
    with ThreadPoolExecutor(options.parallel) as pool:
        loads = [
            pool.submit(run_entity, layers, entity, paths[name], run_ts, options)
            for name, entity in ENTITIES.items()
            if name in paths
        ]
        for load in loads:
            load.result()
    if all(name in paths for name in DIMENSIONS + FACTS):
        load_master_orders(layers, run_ts, options.rewrite_buckets)


def default_paths(directory: str) -> dict[str, str]:
    """One file `<entity>.csv` per entity."""
    return {name: os.path.join(directory, f"{name}.csv") for name in ENTITIES}
