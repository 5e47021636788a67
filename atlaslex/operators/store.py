"""A stored table with one row per key, cut into folders by ranges of the key.

A write reads and replaces only the folders of the keys that it has: a load of new pages looks for them among the stored keys of
their ranges, and an update writes the ranges again that it changes. Keys are whole numbers; ``SPAN`` of them share a folder, or more
if the first write would make over ``FOLDERS`` folders. Rows of a folder meet in one task before they are written (in several
only if they are many), so a write makes about as many files as folders and not as many for each task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaslex.operators.ranking import first_per_key
from atlaslex.operators.upsert import update_by_key
from atlaslex.staging import path_exists, stage

SPAN = 1 << 20
FOLDER = "key_range"
# Folders that a first write makes at most; a store of wider ranges than asked for has their width as a second level of folders.
FOLDERS = 64
WIDTH = "range_width"


@dataclass
class KeyedStore:
    """The table under ``path``, by ``key``."""

    spark: SparkSession
    path: str
    key: str
    span: int = SPAN

    def _range(self, width: float) -> Column:
        return F.floor(F.col(self.key) / width).cast("long")

    def _stored(self) -> DataFrame | None:
        return self.spark.read.parquet(self.path) if path_exists(self.spark, self.path) else None

    def _width(self, rows: DataFrame) -> float:
        """Keys that share a folder: those of the stored table, else ``span``, widened until ``rows`` make ``FOLDERS`` folders at most."""
        stored = self._stored()
        if stored is not None:
            return float(stored.select(WIDTH).first()[0]) if WIDTH in stored.columns else self.span
        ranges, width = stage(rows.select(self._range(self.span).alias(FOLDER)).distinct(), "ranges"), self.span
        # Keys without gaps take one step; of those far apart, every step makes ranges four times as wide at least.
        while (folders := ranges.select(F.floor(F.col(FOLDER) / (width / self.span))).distinct().count()) > FOLDERS:
            width *= max(4.0, 2.0 ** math.ceil(math.log2(folders / FOLDERS)))
        return width

    def read(self) -> DataFrame | None:
        """The whole table, or None before the first write."""
        stored = self._stored()
        return None if stored is None else stored.drop(FOLDER, WIDTH)

    def touched(self, rows: DataFrame, width: float | None = None) -> list[int]:
        """Numbers of the ranges of keys that rows have; a few bytes for each folder come to the driver."""
        return sorted(r[0] for r in rows.select(self._range(width or self._width(rows))).distinct().collect())

    def ranges(self, numbers: list[int]) -> DataFrame | None:
        """The rows of some ranges; other folders are not read."""
        stored = self._stored()
        return None if stored is None else stored.filter(F.col(FOLDER).isin(numbers)).drop(FOLDER, WIDTH)

    def _write(self, rows: DataFrame, mode: str, width: float) -> None:
        by_range, levels, stored = rows.withColumn(FOLDER, self._range(width)), [FOLDER], self._stored()
        if width != self.span if stored is None else WIDTH in stored.columns:
            by_range, levels = by_range.withColumn(WIDTH, F.lit(float(width))), [FOLDER, WIDTH]
        writer = by_range.hint("rebalance", FOLDER).write.mode(mode).partitionBy(*levels)
        (writer.option("partitionOverwriteMode", "dynamic") if mode == "overwrite" else writer).parquet(self.path)

    def insert(self, rows: DataFrame, order: list[Column]) -> None:
        """Add the first row in ``order`` of every key that is not stored; rows without a key are left out."""
        rows = stage(rows.filter(F.col(self.key).isNotNull()), "incoming")
        width = self._width(rows)
        stored = self.ranges(self.touched(rows, width))
        if stored is not None:
            rows = rows.join(stored.select(self.key), self.key, "left_anti")
        self._write(first_per_key(rows, self.key, order), "append", width)

    def update(self, changes: DataFrame, columns: list[str], order: list[Column]) -> None:
        """Replace ``columns`` of stored keys; of several changes of a key the first in ``order`` counts. Unknown keys change nothing."""
        changes = stage(changes.filter(F.col(self.key).isNotNull()), "changes")
        if not path_exists(self.spark, self.path):
            return
        width = self._width(changes)
        numbers = self.touched(changes, width)
        if not numbers:
            return
        # A folder cannot be read and replaced at once: its new rows are stored beside it first.
        self._write(stage(update_by_key(self.ranges(numbers), changes, self.key, columns, order), "changed-ranges"), "overwrite", width)
