"""Versions of a dimension as of a point in time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermart.operators.skew import divided_join
from tiermart.schemas import IS_CURRENT, VALID_FROM, VALID_TO
from tiermart.session import materialise


def as_of(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    at: str,
    columns: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Facts with the dimension columns that were valid at the fact's time `at`.

    A version is valid from its start up to, not including, its end. The keys
    carry the join, hot ones among the facts divided; the interval is tested on
    the matched versions only.
    """
    versions = dim.select(
        *keys, F.col(VALID_FROM).alias("__from"), F.col(VALID_TO).alias("__to"), *columns
    )
    valid = [
        F.col(at) >= F.col("__from"),
        F.col("__to").isNull() | (F.col(at) < F.col("__to")),
    ]
    joined = divided_join(facts, versions, keys, how, valid)
    return joined.select(*facts.columns, *columns)


def as_of_sweep(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    at: str,
    columns: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """As `as_of`, for versions of a key that do not overlap, without comparing facts to versions.

    Facts and versions lie in one order of key and time, and each fact takes the last version that began before
    it, if that has not ended. Work grows with the number of rows only, however many versions a
    key has. The order is divided by ranges, so that a key with a large share of the rows covers several; what
    is valid at the beginning of a range is carried over from the ranges before, one row for each.

    Rows with a null key or time match nothing. Of versions that begin at the same time, the one that ends
    last counts. `how` is left or inner.
    """
    kind = dim.schema[VALID_FROM].dataType
    version = F.struct(
        F.col(VALID_FROM).alias("from"), F.col(VALID_TO).alias("to"), F.struct(*columns).alias("of")
    )
    own = [f"__key_{i}" for i in range(len(keys))]
    key = [F.col(k).alias(name) for k, name in zip(keys, own)]
    # a value that does not fit the type of the fact's key cannot equal one
    kinds = {f.name: f.dataType for f in facts.schema}
    fitted = [F.col(k).try_cast(kinds[k]) for k in keys]
    # a version that ends as it begins is never valid
    lasting = F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.col(VALID_FROM))
    begun = dim.where(
        reduce(and_, [c.isNotNull() for c in [*fitted, F.col(VALID_FROM)]], lasting)
    ).select(
        *[c.alias(name) for c, name in zip(fitted, own)], F.col(VALID_FROM).alias("__at"), F.lit(0).alias("__fact"),
        F.col(VALID_TO).alias("__to"), version.alias("__version"),
    )
    asked = facts.select(
        *key, F.col(at).cast(kind).alias("__at"), F.lit(1).alias("__fact"),
        F.monotonically_increasing_id().alias("__nth"), F.struct(*facts.columns).alias("__row"),
    )
    order = [
        F.asc_nulls_first("__at"), F.asc("__fact"), F.asc_nulls_last("__to"), F.asc_nulls_last("__nth"),
    ]
    ranged = materialise(
        begun.unionByName(asked, allowMissingColumns=True)
        .repartitionByRange(*[F.asc_nulls_first(c) for c in own], *order)
        .withColumn("__range", F.spark_partition_id()),
        "ranges",
    )
    so_far = Window.partitionBy("__range", *own).orderBy(*order)
    swept = ranged.withColumn("__last", F.last("__version", ignorenulls=True).over(so_far))

    # only the first key of a range can have begun before it
    firsts = ranged.groupBy("__range").agg(F.min(F.struct(*own)).alias("k")).select("__range", "k.*")
    spanning = firsts.select(*own).distinct()
    ends = (
        ranged.where("__fact = 0")
        .join(spanning, own, "left_semi")
        .groupBy("__range", *own)
        .agg(F.max_by("__version", F.struct("__at", F.col("__to").isNull(), "__to")).alias("__end"))
    )
    before = Window.partitionBy(*own).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        firsts.join(ends, ["__range", *own], "full")
        .withColumn("__carried", F.last("__end", ignorenulls=True).over(before))
        .where("__carried IS NOT NULL")
        .select("__range", *own, "__carried")
    )
    found = swept.where("__fact = 1").join(
        materialise(carried, "carried"), ["__range", *own], "left"
    )
    last = F.coalesce("__last", "__carried")
    valid = F.when(last["to"].isNull() | (F.col("__at") < last["to"]), last["of"])
    # a null time comes before every version of its key
    result = found.withColumn("__found", F.when(F.col("__at").isNotNull(), valid))
    if how == "inner":
        result = result.where("__found IS NOT NULL")
    return result.select(
        "__row.*", *[F.col("__found")[c].alias(c) for c in columns]
    )


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(IS_CURRENT))
