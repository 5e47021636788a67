"""Repeated passages through enhanced suffix arrays: maximal repeats of ``LENGTH`` bytes or more with all their occurrences.

A suffix array of the whole corpus would be one sort of all its bytes' suffixes. Here the suffixes are dealt so that
equal strings of ``LENGTH`` bytes meet in one task:

1. *Anchors.* In every window of ``LENGTH`` bytes the ``GRAM``-byte string with the smallest hash (the first of equal ones) is the
   window's anchor. Equal windows have equal anchors at the same place. One anchor serves a run of windows, which is
   its context.
2. *Repeated anchors.* Anchors are counted over all documents. Those found twice or more set a bit of a bitmap of
   ``BITMAP_BITS`` bits, the only thing that is broadcast. A second scan cuts out the contexts of anchors whose bit is set; a bit
   that two anchors share only costs a row.
3. *Classes.* Equal contexts of an anchor are one class: its first occurrence, and the others, whose every byte is repeated. A
   passage that a third of all documents share is aggregated before it is shuffled.
4. *Interval trees.* The classes of an anchor meet in one task. Their suffixes of ``LENGTH`` bytes or more are sorted, common
   prefixes of neighbours measured, and a stack scan yields the intervals of the common-prefix tree. An interval is a
   maximal repeat if its occurrences differ in the byte before them, and comes with all its occurrences.
   An anchor with over ``CLASSES`` classes is split instead: its windows are grouped by their own bytes.
5. *Spans.* All occurrences but the first of a repeat are removed.

Order of occurrences: ``doc_id`` (null first), then a hash of the text, then the place. Rows with equal ``doc_id`` and
text are one document: both come out, alike. Null texts are empty. Texts of fewer than ``LENGTH`` bytes have no repeats; they may have any
length, also of one letter.
Other columns are not read, except by ``remove``, which returns them. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType

from atlaslex.llm.batches import arrow_function, cut, text_bytes
from atlaslex.staging import stage

LENGTH = 100
GRAM = 32
BITMAP_BITS = 1 << 27
CLASSES = 1 << 14

#: Bytes of contexts whose suffixes are sorted together; one anchor's classes always are.
SORT_BYTES = 256 << 10

MULTIPLIER = 0xD6E8FEB86659FD93
MASK = 2**64 - 1

#: What a document is called inside: rows with the same name are the same document.
NAME = ("doc_id", "tie")


def named(docs: DataFrame, *others: str) -> DataFrame:
    """``doc_id``, ``tie``, ``bytes`` and the other columns."""
    return docs.select("doc_id", F.xxhash64(text_bytes()).alias("tie"), text_bytes().alias("bytes"), *others)


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, key, first window and last window of every anchor, windows counted from the text's start."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    whole = np.frombuffer(b"".join(texts), dtype=np.uint8)
    none = np.array([], dtype=np.int64)
    if len(whole) < LENGTH:
        return none, none.view(np.uint64), none, none
    # Hash of GRAM bytes by doubling.
    hashed, width, factor = whole.astype(np.uint64) + np.uint64(1), 1, MULTIPLIER
    while width < GRAM:
        hashed = hashed[:-width] * np.uint64(factor) + hashed[width:]
        width, factor = 2 * width, factor * factor & MASK
    hashed ^= hashed >> np.uint64(32)
    hashed *= np.uint64(MULTIPLIER)
    hashed ^= hashed >> np.uint64(29)
    # First smallest hash of every window, by doubling.
    least, place, width = hashed, np.arange(len(hashed), dtype=np.int32), 1
    grams = LENGTH - GRAM + 1
    while width < grams:
        step = min(width, grams - width)
        left = least[:-step] <= least[step:]
        place = np.where(left, place[:-step], place[step:])
        least = np.minimum(least[:-step], least[step:])
        width += step
    ends = np.cumsum(lengths)
    starts = ends - lengths
    # Windows that stay inside of one text: where a text has n bytes, its first n - LENGTH + 1 places.
    inside = np.zeros(len(least), dtype=bool)
    for start, end in zip(starts, ends, strict=True):
        inside[start : max(start, end - LENGTH + 1)] = True
    windows = np.flatnonzero(inside)
    if not len(windows):
        return none, none.view(np.uint64), none, none
    at = place[windows]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(windows) > 1)]))
    first, last = windows[new], windows[np.concatenate([new[1:], [len(windows)]]) - 1]
    of = np.searchsorted(ends, first, side="right")
    return of, hashed[at[new]], first - starts[of], last - starts[of]


def _lists(of: np.ndarray, texts: int, values: pa.Array) -> pa.Array:
    """Values in one list for each text."""
    bounds = np.searchsorted(of, np.arange(texts + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), values)


def _anchor_keys(texts: pa.Array) -> pa.Array:
    done = [pa.array([], pa.list_(pa.int64()))]
    for start, end in cut(pc.binary_length(texts).to_pylist()):
        part = texts.slice(start, end - start).to_pylist()
        of, keys, _, _ = anchors(part)
        done.append(_lists(of, len(part), pa.array(keys.view(np.int64))))
    return pa.concat_arrays(done)


anchor_keys = arrow_function(_anchor_keys, ArrayType(LongType()))

SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
CONTEXT = pa.struct([("key", pa.int64()), ("start", pa.int64()), ("context", pa.binary())])


def _contexts(bitmap):
    """Contexts of the anchors whose bit is set."""

    def run(texts: pa.Array) -> pa.Array:
        set_bits = np.frombuffer(bitmap.value, dtype=np.uint8)
        done = [pa.array([], pa.list_(CONTEXT))]
        for start, end in cut(pc.binary_length(texts).to_pylist()):
            part = texts.slice(start, end - start).to_pylist()
            of, keys, first, last = anchors(part)
            bit = keys & np.uint64(BITMAP_BITS - 1)
            hit = (set_bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            of, keys, first, last = of[hit], keys[hit], first[hit], last[hit]
            found = [part[i][a : b + LENGTH] for i, a, b in zip(of.tolist(), first.tolist(), last.tolist(), strict=True)]
            values = [pa.array(keys.view(np.int64)), pa.array(first), pa.array(found, pa.binary())]
            done.append(_lists(of, len(part), pa.StructArray.from_arrays(values, fields=list(CONTEXT))))
        return pa.concat_arrays(done)

    return arrow_function(run, from_arrow_type(pa.list_(CONTEXT)))


def repeated_bits(docs: DataFrame) -> bytes:
    """Bitmap with a bit set for every anchor that is found twice or more; ``BITMAP_BITS`` / 8 bytes, whatever the input."""
    keys = docs.select(F.explode(anchor_keys(text_bytes())).alias("key"))
    twice = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    bit = F.col("key").bitwiseAND(F.lit(BITMAP_BITS - 1).cast("long"))
    block, place = F.shiftright(bit, 15), bit.bitwiseAND(F.lit((1 << 15) - 1).cast("long"))
    blocks = stage(twice.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(place).alias("bits")), "bitmap")
    whole = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for row in blocks.toLocalIterator():
        whole[row["block"] << 12 : (row["block"] + 1) << 12] = np.frombuffer(row["bits"], dtype=np.uint8)
    return whole.tobytes()


def interval_tree(prefixes: np.ndarray, least: int):
    """(length, first, last) of every common-prefix interval of at least ``least`` bytes, by one scan with a stack.

    ``prefixes[i]`` is what suffixes i and i + 1 of the sorted array share. Children come before parents.
    """
    stack: list[list[int]] = []  # length and first suffix of the open intervals
    for i, shared in enumerate([*prefixes.tolist(), 0]):
        begin = i
        while stack and stack[-1][0] > shared:
            length, begin = stack.pop()
            yield length, begin, i
        if shared >= least and (not stack or stack[-1][0] < shared):
            stack.append([shared, begin])


def maximal_repeats(contexts: list[bytes], least: int = LENGTH):
    """(length, [(context, place), ...]) of every repeat that can be extended neither way in all its occurrences.

    The byte before a context is unknown and counts as different from any other.
    """
    width = max(map(len, contexts))
    sizes = np.array([len(c) for c in contexts])
    text = np.zeros((len(contexts), 2 * width), dtype=np.uint8)
    for row, context in zip(text, contexts, strict=True):
        row[: len(context)] = np.frombuffer(context, dtype=np.uint8)
    counts = np.maximum(sizes - least + 1, 0)
    of = np.repeat(np.arange(len(contexts)), counts)
    at = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    suffixes = np.lib.stride_tricks.sliding_window_view(text, width, axis=1)[of, at]
    order = np.argsort(np.ascontiguousarray(suffixes).view(f"S{width}").ravel(), kind="stable")
    suffixes, of, at = suffixes[order], of[order], at[order]
    left = np.where(at > 0, text[of, at - 1].astype(np.int64), -1 - np.arange(len(of)))
    differ = suffixes[1:] != suffixes[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width) if len(of) > 1 else np.array([], dtype=np.int64)
    rest = sizes[of] - at
    shared = np.minimum(shared, np.minimum(rest[1:], rest[:-1])) if len(of) > 1 else shared
    changes = np.concatenate([[0], np.cumsum(left[1:] != left[:-1])]).tolist() if len(of) else []
    of, at = of.tolist(), at.tolist()
    for length, first, last in interval_tree(shared, least):
        if changes[last] > changes[first]:
            yield length, list(zip(of[first : last + 1], at[first : last + 1], strict=True))


REPEATS = "repeat long, length long, doc_id long, tie long, start long, first boolean"


def _repeats_of_sorted(merged: bool):
    """Repeats of rows that come sorted by key; whole keys are taken together up to ``SORT_BYTES``."""

    def run(batches):
        rows: list[dict] = []
        held, last = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["key"] != last and held >= SORT_BYTES:
                    yield _repeat_rows(rows, merged)
                    rows, held = [], 0
                rows.append(row)
                held += len(row["context"])
                last = row["key"]
        if rows:
            yield _repeat_rows(rows, merged)

    return run


def _repeat_rows(rows: list[dict], merged: bool) -> pa.RecordBatch:
    """Occurrences as columns; if ``merged``, only what is to be removed, and overlapping repeats of a context as one."""
    found: list[tuple] = []
    # Contexts longer than usual would widen all rows of the sort: they are sorted by themselves.
    for wide in (False, True):
        some = [row for row in rows if (len(row["context"]) > 2 * LENGTH) == wide]
        if some:
            found += _merged(_occurrences(some)) if merged else _occurrences(some)
    kinds = [pa.int64()] * 5 + [pa.bool_()]
    columns = list(zip(*found, strict=True)) or [()] * len(kinds)
    names = ["repeat", "length", "doc_id", "tie", "start", "first"]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], names=names)


def _occurrences(rows: list[dict]):
    from xxhash import xxh64_intdigest

    contexts = [row["context"] for row in rows]
    for length, found in maximal_repeats(contexts):
        context, at = found[0]
        name = xxh64_intdigest(contexts[context][at : at + length]) - (1 << 63)
        places = [
            (rows[i]["doc_id"] is not None, rows[i]["doc_id"] or 0, rows[i]["tie"], rows[i]["start"] + at) for i, at in found
        ]
        earliest = min(places)
        for (i, _), place in zip(found, places, strict=True):
            yield name, length, rows[i]["doc_id"], place[2], place[3], place == earliest


def _merged(found):
    """Unions of the occurrences to remove, by document."""
    ranges = sorted(((doc is not None, doc or 0, tie, start, start + length) for _, length, doc, tie, start, first in found if not first))
    done: list[list] = []
    for *document, start, end in ranges:
        if done and done[-1][0] == document and start <= done[-1][2]:
            done[-1][2] = max(done[-1][2], end)
        else:
            done.append([document, start, end])
    return [(0, end - start, d[1] if d[0] else None, d[2], start, False) for d, start, end in done]


def _split_by_window(crowded: DataFrame) -> DataFrame:
    """Repeats of anchors with very many classes: every window is grouped by its own bytes."""
    number = F.octet_length("context") - LENGTH + 1
    windows = crowded.withColumn("at", F.explode(F.sequence(F.lit(1), number))).select(
        F.expr(f"substring(context, at, {LENGTH})").alias("window"),
        F.struct("doc_id", "tie", (F.col("start") + F.col("at") - 1).alias("start")).alias("place"),
    )
    firsts = stage(windows.groupBy("window").agg(F.min("place").alias("earliest"), F.count("*").alias("n")).where("n > 1"), "firsts")
    found = windows.join(firsts, "window")
    return found.select(
        F.xxhash64("window").alias("repeat"), F.lit(LENGTH).cast("long").alias("length"), "place.*",
        (F.col("place") == F.col("earliest")).alias("first"),
    )


def repeats(docs: DataFrame, merged: bool = False) -> DataFrame:
    """All maximal repeats within contexts, one row for each occurrence: ``repeat``, ``length``, document, ``start``, ``first``.

    If ``merged``, tasks give the union of what is to be removed instead of every occurrence of nested repeats.
    """
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(repeated_bits(docs))
    found = named(docs).withColumn("c", F.explode(_contexts(bitmap)(F.col("bytes"))))
    found = found.select(*NAME, "c.*", F.xxhash64("c.context").alias("class"), F.octet_length("c.context").cast("long").alias("length"))
    occurrences = stage(found, "contexts")
    place = F.struct("doc_id", "tie", "start")
    grouped = occurrences.groupBy("key", "class").agg(
        F.min(place).alias("place"), F.count("*").alias("n"), F.first("context").alias("context")
    )
    classes = stage(grouped, "classes")
    single = classes.groupBy("key").agg(F.count("*").alias("classes"), F.sum("n").alias("all"))
    counts = stage(single.where("all > 1"), "class-counts")
    sizes = classes.join(counts, "key").select("key", "context", "place.*", "classes")
    crowded = _split_by_window(sizes.where(F.col("classes") > CLASSES))
    usual = sizes.where((F.col("classes") > 1) & (F.col("classes") <= CLASSES)).drop("classes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = usual.repartition(parts, "key").sortWithinPartitions("key")
    trees = dealt.mapInArrow(_repeats_of_sorted(merged), REPEATS)
    # The other occurrences of a class: every byte of their context stands at the first one as well.
    several = stage(classes.where("n > 1").select("key", "class", F.col("place").alias("earliest")), "several")
    members = occurrences.select("key", "class", "length", "doc_id", "tie", "start").join(several, ["key", "class"])
    copies = members.select(
        F.col("class").alias("repeat"), "length", "doc_id", "tie", "start",
        (F.struct("doc_id", "tie", "start") == F.col("earliest")).alias("first"),
    )
    return trees.unionByName(crowded).unionByName(copies)


def spans(found: DataFrame) -> DataFrame:
    """``doc_id``, ``tie`` and the sorted ``spans`` (start, end) to remove; what overlaps or touches is one span."""
    ranges = found.where("not first").select(*NAME, F.struct("start", (F.col("start") + F.col("length")).alias("end")).alias("s"))
    listed = ranges.groupBy(*NAME).agg(F.sort_array(F.collect_list("s")).alias("s"))
    return listed.select(*NAME, joined("s").alias("spans"))


def _joined(values: pa.Array) -> pa.Array:
    out = []
    for ranges in values.to_pylist():
        done: list[dict] = []
        for r in ranges:
            if done and r["start"] <= done[-1]["end"]:
                done[-1]["end"] = max(done[-1]["end"], r["end"])
            else:
                done.append(r)
        out.append(done)
    return pa.array(out, SPANS)


#: Sorted ranges -> ranges, those that overlap or touch made one.
joined = arrow_function(_joined, from_arrow_type(SPANS))


def _kept(texts: pa.Array, found: pa.Array) -> pa.Array:
    out = []
    for text, ranges in zip(texts.to_pylist(), found.to_pylist(), strict=True):
        parts, at = [], 0
        for r in ranges or ():
            parts.append(text[at : r["start"]])
            at = r["end"]
        out.append(b"".join([*parts, text[at:]]))
    return pa.array(out, pa.binary())


kept_bytes = arrow_function(_kept, BinaryType())


def removals(docs: DataFrame, *others: str) -> DataFrame:
    """Every document with its ``bytes``, ``spans`` (null: none) and the other columns; texts are shuffled once, by name."""
    listed = stage(spans(repeats(docs, merged=True)).withColumnRenamed("doc_id", "of"), "spans")
    rows = named(docs, *others)
    # The spans grow with the documents: they are joined by shuffle at every size.
    listed = listed.hint("merge")
    return rows.join(listed, (rows["tie"] == listed["tie"]) & F.col("doc_id").eqNullSafe(F.col("of")), "left").drop(listed["tie"]).drop("of")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, sizes and the SHA-256 of the remaining bytes."""
    rows = removals(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return rows.select(
        "doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"), F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.sha2(kept_bytes("bytes", "spans"), 256).alias("kept_sha256"),
    )


def remove(docs: DataFrame) -> DataFrame:
    """The documents without their repeated passages, with the columns they had and all rows.

    A character stays if one of its bytes is kept, so texts stay valid. ``n_chars``, if there is one, is counted anew.
    """
    whole = F.struct(*(F.col(c) for c in docs.columns if c != "text"))
    rows = removals(docs.withColumn("_rest", whole), "_rest", "text")
    changed = rows.withColumn("_text", F.when(F.col("spans").isNull(), F.col("text")).otherwise(kept_text("bytes", "spans")))
    values = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    fields = [values.get(c, F.col(f"_rest.{c}")).alias(c) for c in docs.columns]
    return changed.select(*fields)


def _whole_characters(texts: pa.Array, found: pa.Array) -> pa.Array:
    out = []
    for text, ranges in zip(texts.to_pylist(), found.to_pylist(), strict=True):
        parts, at = [], 0
        for r in ranges or ():
            start, end = r["start"], r["end"]
            while start < end and text[start] & 0xC0 == 0x80:
                start += 1
            while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
                end -= 1
            parts.append(text[at:start])
            at = end
        out.append(b"".join([*parts, text[at:]]).decode())
    return pa.array(out, pa.string())


kept_text = arrow_function(_whole_characters, StringType())
