"""Keyed writes as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlaslex.operators.ranking import first_per_key


def new_rows(incoming: DataFrame, existing: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows to append: the first incoming row of each key that ``existing`` does not hold.

    Known keys are removed before the ranking, so a rerun over a loaded dump ranks almost nothing.
    """
    unknown = incoming.filter(F.col(key).isNotNull()).join(existing.select(key), key, "left_anti")
    return first_per_key(unknown, key, order)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``existing`` plus the new rows; a key that is present keeps its row."""
    return existing.unionByName(new_rows(incoming, existing, key, order))


def update_by_key(table: DataFrame, changes: DataFrame, key: str, columns: list[str], order: list[Column] | None = None) -> DataFrame:
    """``table`` with ``columns`` replaced where ``changes`` has the key.

    Of several changes of a key the first in ``order`` counts, by default the one with the smallest values. Rows never multiply.
    """
    changes = first_per_key(changes.filter(F.col(key).isNotNull()), key, order or [F.col(c) for c in columns])
    values = [F.col(c).alias(f"_new_{c}") for c in columns]
    joined = table.join(changes.select(key, *values, F.lit(True).alias("_hit")), key, "left")
    taken = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.select(*[taken[c].alias(c) if c in taken else F.col(c) for c in table.columns])


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Columns of ``defaults``: missing ones are added, NULLs are filled."""
    filled = {
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in defaults.items()
    }
    return df.withColumns(filled)
