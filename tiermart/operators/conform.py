"""From text columns to the declared types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermart.functions import cast_failed
from tiermart.schemas import Entity

Fields = Sequence[tuple[str, T.DataType]]


def conform(df: DataFrame, fields: Fields) -> DataFrame:
    """Cast the listed columns; a value that does not fit aborts the query."""
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in fields})


def conform_entity(df: DataFrame, entity: Entity) -> DataFrame:
    """Typed columns of an entity, its derived columns, then all other columns."""
    rest = [c for c in df.columns if c not in entity.typed_columns]
    typed = conform(df, entity.fields)
    typed = typed.withColumns(
        {name: F.expr(sql).cast(kind) for name, (kind, sql) in entity.derived.items()}
    )
    return typed.select(*entity.typed_columns, *rest)


def conform_or_quarantine(df: DataFrame, fields: Fields) -> tuple[DataFrame, DataFrame]:
    """Split into (typed rows, rows with at least one value that does not fit).

    Quarantined rows keep their text and name the offending columns in
    `_bad_columns`.
    """
    bad = F.filter(
        F.array(
            *[F.when(cast_failed(F.col(name), kind), F.lit(name)) for name, kind in fields]
        ),
        lambda name: name.isNotNull(),
    )
    flagged = df.withColumn("_bad_columns", bad)
    good = flagged.filter(F.size("_bad_columns") == 0).drop("_bad_columns")
    typed = good.withColumns({name: F.col(name).try_cast(kind) for name, kind in fields})
    return typed, flagged.filter(F.size("_bad_columns") > 0)
