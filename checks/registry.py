"""Collects the queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atlaslex.sources.tables import read_table

QUERIES: dict[str, Callable[["Tables"], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one scale factor as attributes, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = read_table(self.spark, f"{self.folder}/{name}.parquet")
        setattr(self, name, df)
        return df


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame``; ``sql`` is left out where SQL cannot express the operator."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from checks import coord_checks, file_checks, map_checks, symbol_checks, text_checks  # noqa: F401
