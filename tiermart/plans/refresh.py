"""The wide table brought up to date: only orders that a load has changed are joined again.

The wide table lies in buckets of its order ids. A refresh looks up which rows of its eight inputs are newer
than what it has seen, follows them to the orders they belong to, joins these orders only, and writes the
buckets they lie in. All other rows, their `data_insert_ts` included, and all other buckets stay.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermart.functions.columns import RunTs
from tiermart.plans.report_state import ReportState, merged, state_of
from tiermart.plans.wide import DIMENSIONS, FACTS, MASTER_COLUMNS, build_master_orders
from tiermart.schemas import UPDATED_TS, VALID_FROM, VALID_TO
from tiermart.sources.segments import Segments
from tiermart.sources.tables import CURATED, Layers

MASTER = "master_orders"
INPUTS = DIMENSIONS + FACTS
_MARKS = 1 + 3 * len(INPUTS)  # of a refresh; behind them stand the loads of the state of the reports
EPOCH = dt.datetime(1970, 1, 1)  # also the latest stamp of a table without any


def master_schema(tables: Mapping[str, DataFrame], **choices) -> T.StructType:
    """Columns of the wide table; nothing is read for them."""
    plan = build_master_orders(tables, str(EPOCH), **{**choices, "split_hot_keys": False})
    return T.StructType([T.StructField(f.name, f.dataType) for f in plan.schema])


def master_segments(
    layers: Layers, tables: Mapping[str, DataFrame], buckets: int, **choices
) -> Segments:
    return Segments(layers, CURATED, MASTER, master_schema(tables, **choices), ["order_id"], buckets)


# ---- what is new in an input ----


@dataclass(frozen=True)
class Mark:
    """How far an input was read: its latest stamp, how many lie before it, and how many up to it.

    Loads add stamps and take none away. If the counts still hold, what is new has a later stamp; if only
    those at the latest stamp grew, it has that or a later one; otherwise a load was stamped in
    the past, and nothing short of the whole input is sure to hold it.
    """

    latest: int
    before: int
    up_to: int


def _stamps(name: str) -> list[str]:
    """Columns that a load sets in the rows that it adds or closes."""
    return [VALID_FROM, VALID_TO] if name in DIMENSIONS else [UPDATED_TS]


def _at(micros: int) -> Column:
    """The wall-clock time of a number of microseconds, in no zone."""
    return F.lit(str(EPOCH + dt.timedelta(microseconds=micros))).cast("timestamp_ntz")


def _look(
    tables: Mapping[str, DataFrame], seen: Mapping[str, Mark]
) -> tuple[dict[str, Mark], dict[str, Column | None]]:
    """The marks of the inputs now, and which rows of each may be new since `seen`; None for all.

    Reads the columns of the stamps only, twice: for the latest, then for the counts. All inputs are read at the
    same time.
    """

    def together(columns: Callable[[str], list[Column]]) -> dict[str, tuple]:
        each = [tables[name].agg(*columns(name)).select(F.lit(name), "*") for name in INPUTS]
        return {row[0]: tuple(row[1:]) for row in reduce(DataFrame.union, each).collect()}

    def counts(name: str) -> list[Column]:
        last, limit = _at(latest[name]), _at(seen[name].latest if name in seen else latest[name])
        conditions = [lambda t: t < last, lambda t: t <= last, lambda t: t < limit, lambda t: t <= limit]
        return [
            reduce(Column.__add__, [F.count(F.when(meets(F.col(c)), 1)) for c in _stamps(name)])
            for meets in conditions
        ]

    def later(name: str, still_before: int, still_up_to: int) -> Column | None:
        if name not in seen or still_before != seen[name].before:
            return None
        limit = _at(seen[name].latest)
        after = still_up_to == seen[name].up_to
        each = [F.col(c) > limit if after else F.col(c) >= limit for c in _stamps(name)]
        return F.coalesce(reduce(Column.__or__, each), F.lit(False))

    # greatest passes over nulls
    found = together(lambda name: [F.greatest(*[F.max(c) for c in _stamps(name)], F.lit(None))])
    latest = {
        name: ((time or EPOCH) - EPOCH) // dt.timedelta(microseconds=1) for name, (time,) in found.items()
    }
    counted = together(counts)
    marks = {name: Mark(latest[name], *counted[name][:2]) for name in INPUTS}
    return marks, {name: later(name, *counted[name][2:]) for name in INPUTS}


# ---- from new rows to orders ----


def affected_orders(
    tables: Mapping[str, DataFrame], new: Mapping[str, DataFrame], address_key: str = "customer_id"
) -> DataFrame:
    """(order_id), once each: orders whose rows of the wide table may differ because of the new rows.

    `new` holds the new rows of the inputs that have any, versions that were closed included. A new dimension row
    leads to orders by the facts that name it; these are read for their keys only.
    """

    def named_by(facts: DataFrame, key: Column, *dimensions: tuple[str, str]) -> list[DataFrame]:
        changed = [new[name].select(F.col(column).alias("__key")) for name, column in dimensions if name in new]
        if not changed:
            return []
        keys = reduce(DataFrame.unionByName, changed)
        found = facts.select("order_id", key.alias("__key")).join(keys.distinct(), "__key", "left_semi")
        return [found.select("order_id")]

    found = [new[name].select("order_id") for name in FACTS if name in new]
    found += named_by(tables["order_items"], F.col("product_id"), ("products", "product_id"))
    found += named_by(
        tables["deliveries"],
        F.col("delivery_partner_id").cast("bigint"),
        ("delivery_partners", "delivery_partner_id"),
    )
    if address_key == "customer_id":
        found += named_by(
            tables["orders"],
            F.col("customer_id"),
            ("customers", "customer_id"),
            ("customer_addresses", "customer_id"),
        )
    else:
        found += named_by(tables["orders"], F.col("customer_id"), ("customers", "customer_id"))
        found += named_by(tables["orders"], F.col(address_key), ("customer_addresses", address_key))
    orders = reduce(DataFrame.unionByName, found)
    return orders.filter("order_id IS NOT NULL").distinct()


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: the buckets it wrote, and whether it built the table anew."""

    touched: Sequence[int]
    whole: bool


def refresh_master_orders(
    layers: Layers,
    tables: Mapping[str, DataFrame],
    run_ts: RunTs = None,
    buckets: int = 256,
    reports: bool = False,
    **choices,
) -> Refreshed:
    """Bring the wide table up to date with its inputs, see `build_master_orders` for these and the choices.

    Equal to a table built anew, but for `data_insert_ts`: an order keeps the time at which its rows were last
    joined. The first refresh, one with other choices than the last, and one after a load
    that was stamped earlier than what was seen, build the whole table. How far each input was read is
    published with the rows in one statement, so a refresh that failed is repeated from where it
    began. New rows are found by scans of the stamps, orders by scans of the keys; joins, shuffles and
    writes grow with what changed.

    With `reports` the state of the reports is kept up as well, see `kept_reports`: what changed orders had
    is taken off, what they have now is added. It is published in the same statement.
    """
    held = master_segments(layers, tables, buckets, **choices)
    kind = zlib.crc32(repr(sorted(choices.items())).encode())
    known = held.marks()
    seen: dict[str, Mark] = {}
    counted = known[_MARKS:]
    if len(known) >= _MARKS and known[0] == kind and bool(counted) == reports:
        seen = {name: Mark(*known[1 + 3 * i : 4 + 3 * i]) for i, name in enumerate(INPUTS)}
    now, newer = _look(tables, seen)
    state = ReportState(layers)
    marks = [kind, *[n for name in INPUTS for n in vars(now[name]).values()]]

    if any(condition is None for condition in newer.values()):
        everything = list(range(len(held.versions())))
        built = build_master_orders(tables, run_ts, **choices)
        held.rewrite(
            built, everything, marks, (lambda rows, load: state.add(load, [], state_of(rows))) if reports else None
        )
        state.forget(counted)
        return Refreshed(everything, whole=True)

    # inputs that hold nothing later than what was seen are not looked at again
    new = {name: tables[name].filter(newer[name]) for name in INPUTS if now[name] != seen[name]}
    empty = layers.spark.createDataFrame([], held.schema)
    if not new:
        return Refreshed([], whole=False)
    orders = layers.stage(
        f"{MASTER}_changed", affected_orders(tables, new, choices.get("address_key", "customer_id"))
    )
    touched = held.touched(orders)
    if not touched:
        held.rewrite(empty, [], [*marks, *counted])
        return Refreshed([], whole=False)
    # stored, so that Spark knows their true size when it picks the joins
    parts = {
        name: layers.stage(f"{MASTER}_{name}", tables[name].join(orders, "order_id", "left_semi"))
        for name in FACTS
    }
    joined = build_master_orders({**tables, **parts}, run_ts, **choices)
    before = held.open_rows(touched)
    kept = before.join(orders, "order_id", "left_anti")

    def further(rows: DataFrame, load: int) -> Sequence[int]:
        added, removed = (df.join(orders, "order_id", "left_semi") for df in (rows, before))
        return state.add(load, counted, state_of(added, removed))

    held.rewrite(
        kept.select(*MASTER_COLUMNS).unionByName(joined), touched, marks, further if reports else None
    )
    if reports:
        state.forget([load for load in counted if load not in held.marks()[_MARKS:]])
    return Refreshed(touched, whole=False)


def kept_reports(layers: Layers, tables: Mapping[str, DataFrame], buckets: int = 256, **choices) -> DataFrame:
    """The state of the reports as of the last refresh, for `report_state.state_reports`."""
    loads = master_segments(layers, tables, buckets, **choices).marks()[_MARKS:]
    if not loads:
        raise ValueError("no state is kept: refresh the wide table with reports=True")
    return merged([ReportState(layers).of(loads)])
