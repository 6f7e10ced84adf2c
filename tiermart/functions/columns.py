"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
# what operators accept as the time of a run
RunTs = Column | dt.datetime | str | None

# Zone of file timestamps and zone of the warehouse.
SOURCE_ZONE = "UTC"
WAREHOUSE_ZONE = "Asia/Kolkata"


def run_timestamp(run_ts: RunTs) -> Column:
    """The time written by an operator: injected, or the current local time.

    All warehouse timestamps are wall-clock times (TIMESTAMP_NTZ), so a stored
    value reads the same whatever the session zone is.
    """
    if run_ts is None:
        return F.localtimestamp()
    if isinstance(run_ts, Column):
        return run_ts
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def convert_timezone(
    ts: Column, source: str = SOURCE_ZONE, target: str = WAREHOUSE_ZONE
) -> Column:
    """Wall-clock time `ts` of zone `source`, as wall-clock time of `target`."""
    return F.convert_timezone(F.lit(source), F.lit(target), ts.cast("timestamp_ntz"))


def instant_in_zone(ts: Column, zone: str = WAREHOUSE_ZONE) -> Column:
    """Wall-clock time in `zone` of an instant (a TIMESTAMP column)."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), ts.cast("timestamp_ntz"))


def to_money(value: Column) -> Column:
    """Two-digit decimal; rounds half up and fails on overflow."""
    return value.cast(MONEY)


def any_changed(
    pairs: Sequence[tuple[Column, Column]], null_safe: bool = False
) -> Column:
    """True where at least one (old, new) pair differs.

    With plain comparison a NULL on either side is not a difference. With
    `null_safe` it is, unless both sides are NULL.
    """
    if null_safe:
        tests = [~old.eqNullSafe(new) for old, new in pairs]
    else:
        tests = [F.coalesce(old != new, F.lit(False)) for old, new in pairs]
    return reduce(or_, tests, F.lit(False))


def cast_failed(value: Column, data_type: T.DataType) -> Column:
    """True where a value is present but does not fit the type."""
    return value.isNotNull() & value.try_cast(data_type).isNull()


def mean(total: Column, count: Column) -> Column:
    """Mean as a double, NULL for no rows."""
    return F.try_divide(total.cast("double"), count)


def exact_mean(total: Column, count: Column, digits: int = 2) -> Column:
    """Mean rounded half up in decimal arithmetic, so no binary digit decides."""
    quotient = F.try_divide(total.cast("decimal(28,2)"), count.cast("decimal(20,0)"))
    return F.round(quotient, digits).cast(T.DecimalType(20, digits))


def percentage(part: Column, whole: Column) -> Column:
    """part / whole * 100 as a double, NULL when `whole` is zero."""
    return F.try_divide(part.cast("double"), whole) * 100


def growth_percentage(current: Column, previous: Column) -> Column:
    """Change from `previous` in percent; NULL without a previous value or at zero."""
    return F.try_divide(
        (current - previous).cast("double"), previous.cast("double")
    ) * 100
