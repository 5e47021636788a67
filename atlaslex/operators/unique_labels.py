"""Give every cluster a label nobody of higher priority has.

Clusters choose in priority order, each the best of its few candidates that is still free; the last candidate is taken
even when it is not. As all words prefer the same clusters, the outcome of this one-by-one choice is the only stable
assignment, and proposal rounds find it in parallel: every cluster proposes its current candidate, a word
stays with its highest-priority proposer, the others move on to their next candidate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from atlaslex.staging import stage

ROUNDS_PER_STAGE = 4
# A cluster moves on from a word of one letter, from a word that a settled cluster of higher priority has, and from a word that an open one
# of higher priority proposes too. A window group holds one row per cluster at most, and there are no more clusters than
# centers were fitted.
_MOVES = """
choice < size(words) - 1
AND (length(get(words, choice)) <= 1 OR coalesce(get(taken, choice) < prio, false) OR min(prio) OVER (PARTITION BY get(words, choice)) <> prio)
"""


def _with_taken(open_: DataFrame, settled: DataFrame) -> DataFrame:
    """Adds to every candidate the highest priority of the settled clusters that have its word."""
    owners = settled.groupBy("word").agg(F.min("prio").alias("owner"))
    each = open_.select("prio", "choice", F.posexplode("words").alias("place", "word")).join(owners, "word", "left")
    entry = F.array_sort(F.collect_list(F.struct("place", "word", "owner")))
    listed = each.groupBy("prio").agg(F.first("choice").alias("choice"), entry.alias("c"))
    return listed.select("prio", F.transform("c", lambda c: c["word"]).alias("words"), "choice", F.transform("c", lambda c: c["owner"]).alias("taken"))


def _judged(open_: DataFrame) -> DataFrame:
    """Adds ``done``: no open cluster of higher priority can still come to the word, or it is the last candidate.

    A word of one letter, or one that a settled cluster of higher priority has, is only kept as the last candidate.
    """
    ahead = open_.select("prio", F.explode(F.expr("slice(words, choice + 1, size(words))")).alias("word"))
    first = ahead.groupBy("word").agg(F.min("prio").alias("first"))
    own = F.expr("get(words, choice)")
    judged = open_.withColumn("word", own).join(first, "word")
    refused = (F.length("word") <= 1) | F.coalesce(F.expr("get(taken, choice)") < F.col("prio"), F.lit(False))
    last = F.col("choice") >= F.size("words") - 1
    return judged.withColumn("done", last | (~refused & (F.col("first") == F.col("prio"))))


def unique_labels(candidates: DataFrame) -> DataFrame:
    """(prio, word) from candidates ``(prio, choice, word)``, ``choice`` counting from 0 without gaps.

    Clusters whose word nobody of higher priority can come to any more are settled and leave the rounds: a stage table holds the
    open ones only, with their few candidates and, beside each, whether a settled cluster has it. Several rounds are run
    per table. The open cluster of highest priority always settles or moves on, so the tables shrink to nothing.
    """
    # All candidates of a cluster travel in one row: as many as the caller ranked (six on the map).
    ranked = candidates.groupBy("prio").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("choice", "word"))), lambda c: c["word"]).alias("words")
    )
    open_ = ranked.withColumns({"choice": F.lit(0), "taken": F.transform("words", lambda w: F.lit(None).cast("long"))})
    settled: DataFrame | None = None
    # Every table settles a cluster or moves one on, so there are no more tables than clusters and candidates.
    for _ in range(2 * candidates.count() + 1):
        for _ in range(ROUNDS_PER_STAGE):
            open_ = open_.selectExpr("prio", "words", "taken", f"choice + cast({_MOVES} as int) as choice")
        # The write itself counts the clusters that stay open.
        left = Observation()
        state = stage(_judged(open_).observe(left, F.count_if(~F.col("done")).alias("open")), "label-state")
        done = state.where("done").select("prio", "word")
        settled = done if settled is None else stage(settled.unionByName(done), "settled")
        if left.get["open"] == 0:
            return settled
        open_ = _with_taken(state.where("not done"), settled)
    raise RuntimeError("labels are not settled: the candidates of a cluster are not numbered without gaps")
