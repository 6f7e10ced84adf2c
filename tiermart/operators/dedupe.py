"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    drop_null_keys: bool = False,
    tie_break: bool = True,
) -> DataFrame:
    """Keep the first row per key in the given order; strings sort descending.

    `tie_break` appends the remaining columns, descending, so the survivor
    never depends on the order of the input. NULL keys form one group unless
    `drop_null_keys` removes them.

    A filter on row number 1 lets Spark cut every key to one row per input
    partition before the shuffle, so a key that holds a large share of the rows
    costs its reducer one row per map task only.
    """
    if drop_null_keys:
        df = df.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    ordering = [F.desc_nulls_last(o) if isinstance(o, str) else o for o in order]
    if tie_break:
        used = {*keys, *(o for o in order if isinstance(o, str))}
        ordering += [F.desc_nulls_last(c) for c in df.columns if c not in used]
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
