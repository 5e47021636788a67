"""Ranks within groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from atlaslex.operators.lookup import broadcast_if_small
from atlaslex.staging import stage

# spark.sql.optimizer.windowGroupLimitThreshold as Spark ships it; parts of a group that are ranked by themselves.
CUT_BY_SPARK = 1000
PARTS = 256
# Bins of a group whose largest values bound what can be among its first rows.
BINS = 32


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their rank from 1.

    ``order`` must be total, so that the result is the same on every run. Spark cuts each group to ``n`` rows before
    the shuffle (WindowGroupLimit), hence a group that holds most of the table still sends few rows to its task. Spark
    does so for small ``n`` only; above ``CUT_BY_SPARK`` the rows are first ranked within ``PARTS`` parts of each group.
    """
    if n > CUT_BY_SPARK:
        part = F.pmod(F.xxhash64(*(F.col(c) for c in df.columns if c not in group)), F.lit(PARTS))
        within = Window.partitionBy(*group, "_part").orderBy(*order)
        parts = df.withColumn("_part", part).withColumn("_in_part", F.row_number().over(within))
        df = parts.filter(F.col("_in_part") <= n).drop("_part", "_in_part")
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return numbered.filter(F.col(rank) <= n)


def leading_by_bound(df: DataFrame, group: list[str], value: str, within: str, n: int) -> DataFrame:
    """Rows of a stored table that can be among the ``n`` of their group with the largest ``value``: few, and never less than those.

    Rows are dealt over bins by a hash of ``within``. The n-th largest of the bins' largest values is a bound, as ``n`` rows reach it. It costs
    a row per group and bin and no sort; a ranking of what is left follows. Groups with rows in less than ``n`` bins come whole.
    """
    bins = df.groupBy(*group, F.pmod(F.xxhash64(within), F.lit(BINS)).alias("_bin")).agg(F.max(value).alias("_most"))
    least = F.get(F.sort_array(F.collect_list("_most"), asc=False), F.lit(n - 1))
    bounds = stage(bins.groupBy(*group).agg(least.alias("_least")).filter("_least is not null"), "bounds")
    bounded = df.join(broadcast_if_small(bounds), group, "left")
    return bounded.filter(F.col("_least").isNull() | (F.col(value) >= F.col("_least"))).select(*df.columns)


def leading_of_runs(group: str, value: str, n: int) -> Column:
    """False for rows that cannot be among the ``n`` of their group with the largest ``value``, as their own batch has ``n`` larger ones.

    Rows of a group that lie one after the other are judged together, so nothing is sorted or shuffled. Some rows too many
    stay, such as ties: a ranking follows.
    """

    def run(groups: pa.Array, values: pa.Array) -> pa.Array:
        number = values.to_numpy(zero_copy_only=False)
        sizes = np.diff(pc.run_end_encode(groups).run_ends.to_numpy(), prepend=0)
        starts = np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(len(sizes)), sizes)
        # Values that are no numbers come last here, and stay.
        least = number[np.lexsort((-number, of))][starts + np.minimum(sizes, n) - 1]
        return pa.array(~(number < least[of]) | (sizes <= n)[of])

    run.__annotations__ = {"groups": pa.Array, "values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, T.BooleanType()).asNondeterministic()(F.col(group), F.col(value).cast("double"))


def best_of_bags(words: str, tfs: str, entries: pa.Table, n: int, unknown: int = -1) -> Column:
    """array<struct<word, tf, df, tf_idf>>: the ``n`` words of a row's ``joined_bag`` with the largest ``tf / df``, ties by word, in no order.

    ``entries`` (word, df) go to every task; a word it does not have has ``unknown`` as df. A batch of bags is looked up and ranked at once.
    """
    known, frequency = entries["word"].combine_chunks(), np.append(entries["df"].to_numpy(), unknown)

    def run(bags: pa.Array, counts: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(counts), 0).to_numpy()
        word, tf = pc.split_pattern(bags, " ").flatten(), counts.flatten().to_numpy()
        if len(word) > len(tf):
            # Rows without words.
            word = word.filter(pc.not_equal(word, ""))
        df = frequency[pc.fill_null(pc.index_in(word, value_set=known), len(known)).to_numpy()]
        of, value = np.repeat(np.arange(len(sizes)), sizes), tf / df
        ends = np.cumsum(sizes)
        least = np.full(len(sizes), -np.inf)
        for row in np.flatnonzero(sizes > n):
            least[row] = np.partition(value[ends[row] - sizes[row] : ends[row]], sizes[row] - n)[sizes[row] - n]
        keep = value > least[of]
        # Those as good as the last place share what is left of the places, in the order of the words.
        tied = np.flatnonzero(value == least[of])
        room = n - np.bincount(of[keep], minlength=len(sizes))
        tied = tied[np.lexsort((pc.rank(word.take(pa.array(tied)), tiebreaker="dense").to_numpy(), of[tied]))]
        first = np.searchsorted(of[tied], of[tied])
        keep[tied[np.arange(len(tied)) - first < room[of[tied]]]] = True
        kept = np.flatnonzero(keep)
        offsets = pa.array(np.searchsorted(of[kept], np.arange(len(sizes) + 1)), pa.int32())
        fields = [word.take(pa.array(kept)), pa.array(tf[kept]), pa.array(df[kept]), pa.array(value[kept])]
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, ["word", "tf", "df", "tf_idf"]))

    run.__annotations__ = {"bags": pa.Array, "counts": pa.Array, "return": pa.Array}
    kind = "array<struct<word:string,tf:bigint,df:bigint,tf_idf:double>>"
    return F.arrow_udf(run, kind).asNondeterministic()(F.col(words), F.col(tfs))


def first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return top_per_group(df, [key], order, 1, "_first").drop("_first")


def number_rows(df: DataFrame, order: str, name: str) -> DataFrame:
    """Global row number from 0 in the order of a unique, non-null key.

    The rows are range-partitioned, sorted and stored with their range and place in it, then shifted by the rows of the
    ranges before. One exchange; one task never sees more than one range.
    """
    ranges = df.repartitionByRange(order).sortWithinPartitions(order)
    # The lower 33 bits of this id count the rows of a partition in the order in which they lie.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = stage(ranges.withColumns({"_range": F.spark_partition_id(), "_at": place}), "ranges")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the range exchange: a number of rows that spark.sql.shuffle.partitions bounds.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = ranged.join(F.broadcast(shift), "_range").withColumn(name, (F.col("_before") + F.col("_at")).cast(T.LongType()))
    return numbered.drop("_range", "_at", "_before")
