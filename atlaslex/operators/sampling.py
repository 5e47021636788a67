"""Samples, prefixes and slices. Where a limit appears here, the limit is the operator."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlaslex.operators.ranking import number_rows
from atlaslex.staging import stage

# Fixed value: the number of pages a whole dump is taken to have when a share of it is asked for.
PAGES_ESTIMATE = 21_000_000


def score(keys: list[str | Column], seed: int) -> Column:
    """A number in [0, 1) that depends on the row's key and the seed only: 52 bits of an MD5, which other engines compute alike."""
    texts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *texts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / float(1 << 52)


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: int = 0) -> DataFrame:
    """Exactly min(n, count) rows drawn without replacement; the same rows on every run.

    The n smallest hash scores win. After a count, for which a stored table is not read, one scan stores the rows below a cut
    that leaves about n of them; the sort handles these and not the table. The cut is widened, with another scan,
    in the rare case that it left fewer than n rows (six standard deviations).
    """
    total = df.count()
    if total <= n:
        return df
    (name,) = [f"{'_' * i}score" for i in range(1, 9) if f"{'_' * i}score" not in df.columns][:1]
    scored = df.withColumn(name, score(keys, seed))
    cut = (n + 6 * math.sqrt(n) + 10) / total
    drawn = stage(scored.filter(F.col(name) < cut), "drawn")
    while cut < 1 and drawn.count() < n:
        cut *= 2
        drawn = stage(scored.filter(F.col(name) < cut), "drawn")
    return drawn.orderBy(name, *keys).limit(n).drop(name)


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in key order, for a small ``n``."""
    return df.orderBy(*order).limit(n)


def prefix_rows(share: float, estimate: int = PAGES_ESTIMATE) -> int:
    """Pages that make up ``share`` of a dump of ``estimate`` pages, and the one that crosses the mark."""
    return int(math.floor(estimate * share)) + 1


def prefix_share(pages: DataFrame, share: float, estimate: int = PAGES_ESTIMATE, order: str = "page_id") -> DataFrame:
    """The leading pages that make up ``share`` of a dump of ``estimate`` pages, plus the one that crosses the mark.

    Only the keys are ranked, range by range; the pages are then filtered by the last key, which Parquet can skip on.
    """
    if share >= 1:
        return pages
    n = prefix_rows(share, estimate)
    ranked = number_rows(pages.select(order), order, "_row")
    last = ranked.filter(F.col("_row") < n).agg(F.max(order).alias("last")).first()["last"]
    return pages.filter(F.col(order) <= F.lit(last))


def contiguous_slice(df: DataFrame, begin: int, n: int, order: str) -> DataFrame:
    """Rows ``begin`` .. ``begin + n - 1`` (from 0) in the order of a unique key.

    Only the keys are ranked; the rows are filtered by the first and the last key of the slice.
    """
    ranked = number_rows(df.select(order), order, "_row").filter(F.col("_row").between(begin, begin + n - 1))
    ends = ranked.agg(F.min(order).alias("low"), F.max(order).alias("high")).first()
    return df.filter(F.col(order).between(F.lit(ends["low"]), F.lit(ends["high"])))


def random_slice(df: DataFrame, n: int, order: str, seed: int = 0) -> DataFrame:
    """``n`` consecutive rows from a position drawn with ``seed``."""
    import random

    begin = random.Random(seed).randint(0, max(df.count() - n, 0))
    return contiguous_slice(df, begin, n, order)
