"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

A fingerprint has eight bytes. Two fingerprints that differ in at most two bits differ in at most two of them, so they
share at least ``SHARED`` = 6 positional bytes, and of the four pairs of neighbouring bytes at least two whole pairs. The index
therefore posts every fingerprint under each two of its four byte pairs (six keys of four positional bytes: one byte
alone has 256 values and would post millions together). Two fingerprints under one key are a candidate: their shared
positional bytes are tallied, those that reach six are kept, and the differing bits are counted.

A key that posts more than ``POSTINGS`` fingerprints is not paired at all. Its fingerprints take an exact way without pairs:
each is posted under itself and its 64 neighbours at one bit. Fingerprints at two bits or fewer meet under one of these, and no
such key can hold more than 65 fingerprints, however large a group of near copies is.

Copies share a fingerprint, so the index works on different fingerprints only and copies are never paired.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is linked like any other. A null
``doc_id`` counts in its component but cannot name it: ``component_id`` is the smallest id that is not null, and null only if
there is none. Repeated rows come out as often as they go in. Extra columns are not read, except by ``keep_one``, which
returns them. Texts may have any length. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlaslex.llm.batches import LOWER_CASE, long_struct, text_bytes, text_function, unused
from atlaslex.llm.components import connected_components
from atlaslex.staging import stage

SHINGLE, SEED, BITS = 3, 42, 2
SHARED = 8 - BITS
POSTINGS = 64

#: Hashes whose bits are counted in one step.
BLOCK = 1 << 16


def simhash(text: bytes) -> int:
    """Fingerprint of one text as a signed 64-bit number."""
    from xxhash import xxh64_intdigest

    words = text.translate(LOWER_CASE).split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    hashes = np.array([xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[start : start + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


fingerprint_of = text_function(long_struct("fp"), lambda texts: {"fp": [simhash(text) for text in texts]})


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp`` of every document."""
    return docs.select("doc_id", fingerprint_of(text_bytes()).alias("f")).select("doc_id", "f.fp")


def _byte(value: str, position: int) -> Column:
    return F.shiftrightunsigned(F.col(value), 8 * position).bitwiseAND(F.lit(255).cast("long"))


def _pair(value: str, position: int) -> Column:
    """Two neighbouring bytes."""
    return F.shiftrightunsigned(F.col(value), 16 * position).bitwiseAND(F.lit(0xFFFF).cast("long"))


def postings(different: DataFrame) -> DataFrame:
    """``key`` and ``fp``: six entries of four positional bytes for every fingerprint."""
    keys = [
        F.lit(i).cast("long") * (1 << 32) + _pair("fp", a) * (1 << 16) + _pair("fp", b)
        for i, (a, b) in enumerate(combinations(range(4), 2))
    ]
    return different.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _links_of_short_lists(short: DataFrame) -> DataFrame:
    """Candidates under one key, tallied and verified."""
    other = short.select(F.col("key").alias("k"), F.col("fp").alias("v"))
    both = short.withColumnRenamed("fp", "u")
    differing = F.col("u").bitwiseXOR(F.col("v"))
    tally = sum(((_byte("u", i) == _byte("v", i)).cast("int") for i in range(8)), F.lit(0))
    meets = (F.col("key") == F.col("k")) & (F.col("u") < F.col("v")) & (tally >= SHARED) & (F.bit_count(differing) <= BITS)
    return both.join(other, meets).select("u", "v")


def _links_of_long_lists(long: DataFrame) -> DataFrame:
    """Every fingerprint with the smallest one that it meets under itself or a neighbour at one bit."""
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)))
    near = long.select("fp", F.explode(F.transform(flips, lambda bit: F.col("fp").bitwiseXOR(bit))).alias("near"))
    groups = near.groupBy("near").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return groups.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v"))


def links(different: DataFrame, most: int = POSTINGS) -> DataFrame:
    """Pairs ``u``, ``v`` that connect all fingerprints at ``BITS`` or fewer differing bits; ``different`` is a stored table of ``fp``."""
    counts = postings(different).groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    posted = stage(postings(different).join(stage(counts, "key-counts"), "key"), "postings")
    short = _links_of_short_lists(posted.where(F.col("n") <= most).select("key", "fp"))
    long = _links_of_long_lists(posted.where(F.col("n") > most).select("fp").distinct())
    return short.unionByName(long)


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two stored tables: ``doc_id`` and ``fp`` of every document; ``fp``, ``root`` and ``component_id`` of every fingerprint."""
    found = stage(fingerprints(docs), "fingerprints")
    different = stage(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "different")
    roots = connected_components(links(different)).withColumnRenamed("node", "fp")
    rooted = stage(different.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return found, stage(rooted.join(smallest, "root").select("fp", "root", "component_id"), "classes")


def components(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every document."""
    found, classes = _classes(docs)
    return found.join(classes.drop("root"), "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: str = "fp") -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _one_each(rows: DataFrame, columns: list[str], *keys: str) -> DataFrame:
    """Of all rows with the same keys the one whose text has the smallest hash."""
    row = F.min_by(F.struct(*columns), F.xxhash64(text_bytes()))
    return rows.groupBy(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys))).agg(row.alias("row")).select("row.*")


def keep_one(docs: DataFrame) -> DataFrame:
    """Exactly one row of every component, with the columns it had: the one with the smallest id, then fingerprint, then
    hash of the text.

    A row with a null id stays only where the component has no other. Texts are shuffled once, by ``doc_id``, against the narrow
    table of the ids that stay. Only where an id stands in several rows is their fingerprint told again.
    """
    found, classes = _classes(docs)
    # A null id is last.
    order = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "fp"))
    least = found.groupBy("fp").agg(order.alias("f")).join(classes, "fp").groupBy("root").agg(F.min("f").alias("f"))
    first = stage(least.select("f.doc_id", "f.fp"), "firsts")
    named = first.where("doc_id is not null")
    repeated = stage(found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    staying = named.join(repeated, "doc_id", "left_anti").select("doc_id")
    several = stage(named.join(repeated, "doc_id", "left_semi"), "several")
    # The ids that stay grow with the documents: they are never broadcast, whatever their size.
    single = docs.join(staying.hint("merge"), "doc_id", "left_semi")
    fp, of, value = unused(docs, "fp", "of", "value")
    told = docs.join(several.select("doc_id").distinct(), "doc_id", "left_semi").withColumn(fp, fingerprint_of(text_bytes())["fp"])
    pairs = several.select(F.col("doc_id").alias(of), F.col("fp").alias(value))
    one_each = _one_each(told.join(pairs, (told["doc_id"] == pairs[of]) & (told[fp] == pairs[value]), "left_semi"), docs.columns, "doc_id", fp)
    nameless = first.where("doc_id is null").select(F.col("fp").alias(value))
    without = docs.where("doc_id is null").withColumn(fp, fingerprint_of(text_bytes())["fp"])
    rest = _one_each(without.join(nameless, without[fp] == nameless[value], "left_semi"), docs.columns, fp)
    return single.unionByName(one_each).unionByName(rest)
