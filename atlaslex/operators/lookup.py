"""Joins of a large table with a table that has one row per key.

A broadcast is used only after the size of the broadcast side was measured. Beyond the limit the join is split:
keys that make up a large share of the rows go to a broadcast of those few keys (a key counts as hot when it holds at
least 1/HOT_KEYS of all rows, so there are at most HOT_KEYS of them), the others are shuffled. Hot keys travel as
64-bit hashes, so their length does not matter; a key that shares such a hash only takes the broadcast way too. No task
ever receives a hot key's rows, and every row takes exactly one of the two ways.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlaslex.staging import stage

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_KEYS = 10_000


def _bytes_of(field: T.StructField) -> Column:
    """Bytes of a column's values beside the fixed cost of a column."""
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.octet_length(field.name)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.octet_length(F.to_json(F.struct(F.col(field.name))))
    return F.lit(0)


def estimated_bytes(df: DataFrame) -> int:
    """Measured size of ``df`` as broadcast rows: the bytes of texts and nested values plus a fixed cost per row and column."""
    total = F.count(F.lit(1)) * (16 + 8 * len(df.columns))
    for field in df.schema:
        total = total + F.coalesce(F.sum(_bytes_of(field)), F.lit(0))
    return df.agg(total.alias("bytes")).first()["bytes"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its measured size is within ``limit``, else ``df`` itself.

    ``df`` is read once for the measure, so it should be a stored table or cheap to compute.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def hot_keys(rows: DataFrame, key: str, share: int = HOT_KEYS) -> DataFrame:
    """``_hash`` of the keys that hold at least 1/``share`` of the rows; ``share`` rows at most."""
    counts = stage(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    return heavy_keys(counts, key, "n", share)


def heavy_keys(counts: DataFrame, key: str, weight: str, share: int = HOT_KEYS) -> DataFrame:
    """As ``hot_keys``, from a stored table of row counts per key."""
    total = counts.agg(F.sum(weight).alias("n")).first()["n"] or 0
    hot = (F.col(weight) * share >= total) & F.col(key).isNotNull()
    return counts.filter(hot).select(F.xxhash64(key).alias("_hash")).distinct()


def lookup_join(
    rows: DataFrame,
    entries: DataFrame,
    key: str,
    how: str = "inner",
    hot: Callable[[], DataFrame] | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``rows`` with ``entries`` (one row per ``key``); ``how`` is inner, left or left_semi.

    ``rows`` is read twice when the split applies, so it should be a stored table. ``hot`` may give the heavy keys when
    their counts are known already; it is asked only then.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(how)
    if estimated_bytes(entries) <= limit:
        return rows.join(F.broadcast(entries), key, how)
    hot_rows = F.broadcast(hot_keys(rows, key) if hot is None else hot())

    def parted(df: DataFrame, kind: str) -> DataFrame:
        return df.withColumn("_hash", F.xxhash64(key)).join(hot_rows, "_hash", kind).drop("_hash")

    # Few entries, but of any length: they are measured once more.
    hot_entries = broadcast_if_small(parted(entries, "left_semi"), max(limit, BROADCAST_BYTES))
    # Rows without a key match nothing: a left join keeps them, and they must not meet in one task either.
    keyed = rows.filter(F.col(key).isNotNull())
    stay = parted(keyed, "left_semi")
    if how == "left":
        stay = stay.unionByName(rows.filter(F.col(key).isNull()))
    move = parted(keyed, "left_anti")
    return stay.join(hot_entries, key, how).unionByName(move.join(entries.hint("merge"), key, how))
