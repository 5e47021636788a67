"""Homomorphic multiset fingerprints, with DataFrame operations only.

A text is a multiset of paragraphs: what stands between line breaks, cut further after the end of a sentence, so that one
long line is not one single element. Every paragraph is hashed to a wide vector of ``LANES`` bytes; a fingerprint is the sum of
the vectors, lane by lane, modulo 2^32. The sum does not depend on the order, and a paragraph is inserted or deleted by adding
or subtracting its vector (``combine``), without the rest of the text.

The bytes are taken as signed numbers around zero. So the vectors of different paragraphs are nearly at right angles, and
the cosine of two fingerprints estimates the paragraphs that two texts share, with a standard error of about
1 / sqrt(LANES). That is the ``likeness``, with values below 0 taken as 0; equal fingerprints have likeness 1.

Defined cases: a null or empty text has no paragraphs and the fingerprint zero, which is like itself only. The order
that ``with_next`` uses is by ``doc_id``, null first, then by a hash of the text; equal rows follow each other. One single
document follows itself. Extra columns are not read. Texts may have any length: memory follows the longest one. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 64
MODULUS_BITS = 32

#: Line breaks, and white space after a sentence.
BREAKS = r"[\n\r]+|(?<=[.!?;|])[ \t]+"

#: Document ranges for one shuffle partition.
RANGES = 2


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text, blank ones left out."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BREAKS), lambda p: F.trim(p) != "")


def _hashes(pieces: Column, number: int) -> Column:
    """The ``number``-th 64-bit hash of every paragraph: eight lanes of its vector."""
    return F.transform(pieces, lambda p: F.xxhash64(F.lit(number), p))


def _lane_sum(hashes: Column, byte: int) -> Column:
    """Sum of one signed byte of the hashes."""

    def add(total: Column, h: Column) -> Column:
        return total + F.shiftrightunsigned(h, 8 * byte).bitwiseAND(F.lit(255).cast("long")) - 128

    return F.aggregate(hashes, F.lit(0).cast("long"), add)


def modulo(value: Column) -> Column:
    return value.bitwiseAND(F.lit((1 << MODULUS_BITS) - 1).cast("long"))


def with_fingerprint(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the fingerprint of a text column, an array of ``LANES`` longs."""
    names = [f"_hashes_{k}" for k in range(LANES // 8)]
    pieces = docs.withColumn("_pieces", paragraphs(F.col(text)))
    wide = pieces.withColumns({n: _hashes(F.col("_pieces"), k) for k, n in enumerate(names)})
    lanes = [modulo(_lane_sum(F.col(n), byte)) for n in names for byte in range(8)]
    return wide.withColumn(name, F.array(*lanes)).drop("_pieces", *names)


def combine(left: Column, right: Column, sign: int = 1) -> Column:
    """Fingerprint of both multisets together (``sign`` 1), or of the left one without the right one (-1)."""
    return F.zip_with(left, right, lambda a, b: modulo(a + b * sign))


def likeness(left: str, right: str) -> Column:
    """Cosine of two fingerprints, between 0 and 1."""

    def signed(v: Column) -> Column:
        return (v - F.when(v >= 1 << (MODULUS_BITS - 1), 1 << MODULUS_BITS).otherwise(0)).cast("double")

    def dot(a: Column, b: Column) -> Column:
        products = F.zip_with(a, b, lambda x, y: signed(x) * signed(y))
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    a, b = F.col(left), F.col(right)
    length = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    cosine = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(a, b) / length))).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(cosine)


def text_form(fingerprint: str) -> Column:
    """A fingerprint as lowercase hex digits, eight for a lane."""
    return F.array_join(F.transform(fingerprint, lambda v: F.lower(F.lpad(F.hex(v), MODULUS_BITS // 4, "0"))), "")


def range_bounds(docs: DataFrame, ranges: int) -> list[int]:
    """Smallest ``doc_id`` of each of at most ``ranges`` ranges of about equally many rows; ids of the table itself."""
    places = [i / ranges for i in range(ranges)]
    found = docs.agg(F.min("doc_id").alias("low"), F.percentile_approx("doc_id", places, 100 * ranges).alias("ids")).first()
    return [] if found["low"] is None else sorted({found["low"], *found["ids"]})


def range_of(bounds: list[int]) -> Column:
    """The last range that starts at ``doc_id`` or before it, by bisection; null ids belong to the first."""
    starts, steps = F.array(*(F.lit(b).cast("long") for b in bounds)), max(1, (len(bounds) - 1).bit_length())

    def halve(place: Column, step: Column) -> Column:
        ahead = place + F.element_at(F.array(*(F.lit(1 << (steps - 1 - i)) for i in range(steps))), step)
        inside = F.coalesce((ahead < len(bounds)) & (F.get(starts, ahead) <= F.col("doc_id")), F.lit(False))
        return F.when(inside, ahead).otherwise(place)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0), halve)


def with_next(docs: DataFrame, *columns: str) -> DataFrame:
    """Adds ``next_<column>`` of the following document in the order of ``doc_id``; the first one follows the last.

    The table is cut into ranges of ids of about equal size, and texts are shuffled once, by range. Ranges start at ids
    of the table: documents with such an id are sent to the range before as well, where they only follow the last one.
    The bounds are the only values on the driver: ``RANGES`` times the number of shuffle partitions.
    """
    ranges = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(docs, ranges) or [0]  # without any id all rows are ties
    starts = F.array(*(F.lit(b).cast("long") for b in bounds))
    dealt = docs.withColumn("_tie", F.xxhash64(F.coalesce(F.col("text"), F.lit("")))).withColumn("_range", range_of(bounds))
    home = F.struct(F.col("_range").alias("range"), F.lit(0).alias("guest"))
    visit = F.struct(F.pmod(F.col("_range") - 1, F.lit(len(bounds))).alias("range"), F.lit(1).alias("guest"))
    begins = F.col("doc_id").isNull() | (F.col("doc_id") == F.get(starts, F.col("_range")))
    dealt = dealt.withColumn("_at", F.explode(F.when(begins, F.array(home, visit)).otherwise(F.array(home))))
    order = Window.partitionBy("_at.range").orderBy("_at.guest", F.col("doc_id").asc_nulls_first(), "_tie")
    followed = dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return followed.where("_at.guest = 0").drop("_tie", "_range", "_at")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every document; texts do not move."""
    return with_fingerprint(docs.select("doc_id", "text"), "text", "fingerprint").drop("text")


def edited(docs: DataFrame) -> DataFrame:
    """Every document, its fingerprint, its edited text and that one's fingerprint, and its likeness to both texts' neighbours.

    The edit replaces the last half of the characters by the first ones of the next document.
    """
    own = with_fingerprint(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "fingerprint")
    pairs = with_next(own, "text", "fingerprint")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    changed = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half)
    )
    texts = pairs.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited_text", changed).drop("text", "next_text")
    both = with_fingerprint(texts, "edited_text", "edited_fingerprint")
    return both.withColumns(
        {"near_edited": likeness("fingerprint", "edited_fingerprint"), "near_next": likeness("fingerprint", "next_fingerprint")}
    )
