"""Which keywords coordinate templates use, with examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlaslex.functions import strip
from atlaslex.functions.coords import keyword_example, keyword_map
from atlaslex.operators.sampling import sample_rows

# Fixed value: keywords used up to this often are left out of the report.
RARE_UP_TO = 10


def keyword_usage(tags: DataFrame) -> DataFrame:
    """(keyword, uses) over templates ``(coords)``; keys are trimmed for counting."""
    keys = tags.select(F.explode(F.map_keys(keyword_map(F.col("coords")))).alias("key"))
    return keys.groupBy(strip(F.col("key")).alias("keyword")).agg(F.count(F.lit(1)).alias("uses"))


def common_keywords(usage: DataFrame, threshold: int = RARE_UP_TO) -> DataFrame:
    """Keywords used more than ``threshold`` times."""
    return usage.filter(F.col("uses") > threshold)


def keyword_values(tags: DataFrame, keyword: str) -> DataFrame:
    """(page_id, value): what every template gives for one keyword."""
    found = tags.select("page_id", keyword_example(F.col("coords"), keyword).alias("value"))
    return found.filter(F.col("value").isNotNull())


def keyword_examples(tags: DataFrame, keyword: str, n: int = 1, seed: int = 0) -> DataFrame:
    """``n`` random values of one keyword."""
    return sample_rows(keyword_values(tags, keyword), n, ["page_id"], seed)
