"""Spelling variants: near words by a sorted scan that reuses banded edit-matrix rows.

Two words are near if one inserted, deleted or replaced code point makes one of the other. A word's form is the most
frequent near word, if that is ``SHARE`` times as frequent as the word itself; its root is the last word of the chain of forms.

The scan (``near_pairs``) goes through a sorted list for every word of it. The edit matrix has three diagonals. Two neighbours
of the list share their first code points, so the rows of these are kept and only the rest is computed. Where all three cells
exceed one edit, every word with the same beginning is beyond it too: the scan jumps to the first one that shares less.

One list of all words could not be dealt out. An edit changes one place of the shorter word, of m code points, and leaves what
is before and behind it. The m + 1 places are cut into ``WINDOWS`` windows; for each of them words are posted under what is
left of and right of the window, as a word of m and as one of m + 1 code points. So near words meet in the block of the
window that has their edit's place (the length of their common prefix), and only there. A block of more than ``CROWD`` words is
posted again under two smaller windows, down to one place, where a block can hold no more words than an alphabet has letters
for two places. Blocks are sorted by Spark, those that need it from their ends, so that what they share comes first.

Memory: a task holds one block. Only aggregates come to the driver. The vocabulary is never broadcast.

Defined cases: a null or empty text has no words; a null ``doc_id`` writes as nothing where a hash needs it; repeated rows count
as often as they stand there; other columns are not read. In ``groups``, words that are null or empty are left out and repeated
words are one with the sum of their counts. Words and texts may have any length. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlaslex.llm.batches import LOWER_CASE, cut, text_bytes
from atlaslex.operators.lookup import broadcast_if_small
from atlaslex.staging import stage

LEAST, OCCURRENCES, SHARE = 7, 2, 10
WINDOWS, CROWD, CROWD_CHARS = 4, 2048, 1 << 22

#: Different words that a task counts before it hands them on.
HELD = 1 << 18


def _counter(least: int, slips: int | None):
    run = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def words_of(doc_id: int | None, text: bytes) -> Iterator[tuple[str, int]]:
        found = Counter(run.findall(text.translate(LOWER_CASE).decode()))
        if slips is None:
            yield from found.items()
            return
        seed = crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
        for word, n in found.items():
            h = crc32(word.encode(), seed)
            if h % slips == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
                if len(word) < least:
                    continue
            yield word, n

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run_batches(batches):
        counts: Counter = Counter()
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for start, end in cut(pc.binary_length(texts).to_pylist()):
                part = zip(ids.slice(start, end - start).to_pylist(), texts.slice(start, end - start).to_pylist(), strict=True)
                for doc_id, text in part:
                    for word, n in words_of(doc_id, text):
                        counts[word] += n
                if len(counts) > HELD:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    return run_batches


def vocabulary(docs: DataFrame, least: int = LEAST, occurrences: int = OCCURRENCES, slips: int | None = None) -> DataFrame:
    """``word`` and ``n`` of all words of ``least`` code points that stand at ``occurrences`` places or more.

    Words are maximal runs of Latin letters up to U+00FF, A-Z as a-z. If ``slips`` is given, about one of that many words of a
    document loses a code point first, told by the CRC of ``doc_id`` and word: known misspellings, to see what is found.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    counted = rows.mapInArrow(_counter(least, slips), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def common(a: str, b: str) -> int:
    """Code points that both words begin with."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    at = 0
    while a[at] == b[at]:
        at += 1
    return at


def next_row(row: tuple[int, int, int], word: str, depth: int, letter: str) -> tuple[int, int, int]:
    """The three cells of ``word`` around the diagonal after one more ``letter``; 2 stands for all beyond one edit.

    ``row`` has the edits between the first ``depth`` letters of the list's word and depth - 1, depth, depth + 1 of ``word``.
    """
    less, same, more = row
    size = len(word)
    left = min(less + (depth == 0 or word[depth - 1] != letter), same + 1, 2) if depth <= size else 2
    middle = min(same + (word[depth] != letter), left + 1, more + 1, 2) if depth < size else 2
    right = min(more + (word[depth + 1] != letter), middle + 1, 2) if depth + 1 < size else 2
    return left, middle, right


def near_pairs(words: list[str]) -> Iterator[tuple[int, int]]:
    """Places i < j of different words of a sorted list that are one edit apart."""
    size = len(words)
    shared = [0] + [common(words[j - 1], words[j]) for j in range(1, size)]
    # The next place that shares less with its predecessor.
    jump, open_places = [size] * size, []
    for j in range(1, size):
        while open_places and shared[open_places[-1]] > shared[j]:
            jump[open_places.pop()] = j
        open_places.append(j)
    for i in range(size - 1):
        word, j = words[i], i + 1
        end, base = len(word), shared[j]
        rows = [(1 if base else 2, 0, 1 if base < end else 2)]
        while True:
            other = words[j]
            depth, row, near = base + len(rows) - 1, rows[-1], True
            for letter in other[depth:]:
                row = next_row(row, word, depth, letter)
                if row == (2, 2, 2):
                    near = False
                    break
                rows.append(row)
                depth += 1
            j += 1
            if near:
                if -1 <= end - depth <= 1 and row[end - depth + 1] == 1:
                    yield i, j - 1
            else:  # all that share ``depth + 1`` letters with this one are too far
                while j < size and shared[j] > depth:
                    j = jump[j]
            if j >= size:
                break
            if shared[j] < base:
                base = shared[j]
                rows = [(1 if base else 2, 0, 1 if base < end else 2)]
            else:
                del rows[shared[j] - base + 1 :]


def _block(rows: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
    """Every word of a block with its near words there, the most frequent one's count and itself."""
    sizes, low, high, back = rows[0][2:6]
    listed = [row[0] for row in rows]
    found: dict[int, tuple[int, int, str]] = {}
    for i, j in near_pairs(listed):
        a, b = (listed[i][::-1], listed[j][::-1]) if back else (listed[i], listed[j])
        if min(len(a), len(b)) != sizes or not low <= common(a, b) < high:
            continue  # met in another block
        for place, other, n in ((i, b, rows[j][1]), (j, a, rows[i][1])):
            count, best, name = found.get(place, (0, -1, ""))
            if n > best or (n == best and other < name):
                best, name = n, other
            found[place] = count + 1, best, name
    for place, (count, best, name) in found.items():
        yield (listed[place][::-1] if back else listed[place]), count, best, name


def _scan(batches):
    """Near words of rows that come sorted by block and word."""
    held: list[tuple] = []
    last = None
    out: list[tuple] = []

    def result() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "near", "best", "name"])

    for batch in batches:
        keys = batch.column("key").to_numpy()
        values = [batch.column(c).to_pylist() for c in ("listed", "n", "m", "low", "high", "back")]
        bounds = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(bounds, bounds[1:], strict=False):
            if start == end:
                continue
            if keys[start] != last:
                if len(held) > 1:
                    out += _block(held)
                held, last = [], keys[start]
            if end - start > 1 or held or end == len(keys):
                held += zip(*(v[start:end] for v in values), strict=True)
        if out:
            yield result()
            out = []
    if len(held) > 1:
        out += _block(held)
    yield result()


def _posted(rows: DataFrame, windows: Column) -> DataFrame:
    """Rows of ``word``, ``n`` and ``m``, once for each of their ``windows`` (low, high), with the key of its block."""
    each = rows.select("word", "n", "m", F.explode(windows).alias("w")).select("word", "n", "m", "w.low", "w.high").where("low < high")
    behind = "greatest(m - high, 0)"
    back = F.expr(f"{behind} > low")
    return each.select(
        F.xxhash64("m", "low", "high", F.expr("left(word, low)"), F.expr(f"right(word, {behind})")).alias("key"),
        "word", "n", "m", "low", "high", back.alias("back"),
    )


def _window(low: Column, high: Column) -> Column:
    return F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``near`` (how many words are near), ``best`` (the largest of their counts) and ``name`` (that word); only words with one.

    ``words`` is a stored table of different ``word`` and their counts ``n``.
    """
    length = F.char_length("word")
    sizes = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).where("m > 0")
    places = F.col("m") + 1
    rows = _posted(sizes, F.array(*(_window(F.floor(places * i / WINDOWS), F.floor(places * (i + 1) / WINDOWS)) for i in range(WINDOWS))))
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = []
    while True:
        counts = rows.groupBy("key").agg(F.count("*").alias("words"), F.sum(F.char_length("word")).alias("chars"), F.max(F.col("high") - F.col("low")).alias("wide"))
        crowded = counts.where((F.col("wide") > 1) & ((F.col("words") > CROWD) | ((F.col("chars") > CROWD_CHARS) & (F.col("words") > 2))))
        crowded = stage(crowded.select("key"), "crowded-blocks")
        some = not crowded.isEmpty()
        usual = rows.join(broadcast_if_small(crowded), "key", "left_anti") if some else rows
        listed = usual.withColumn("listed", F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))).drop("word")
        dealt = listed.repartition(parts, "key").sortWithinPartitions("key", "listed")
        found.append(stage(dealt.mapInArrow(_scan, "word string, near long, best long, name string"), "near-words"))
        if not some:
            break
        again = rows.join(broadcast_if_small(crowded), "key", "left_semi")
        half = F.floor((F.col("low") + F.col("high")) / 2)
        rows = stage(_posted(again, F.array(_window(F.col("low"), half), _window(half, F.col("high")))), "smaller-windows")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    first = F.min(F.struct((-F.col("best")).alias("less"), "name"))
    return every.groupBy("word").agg(F.sum("near").alias("near"), first.alias("f")).select("word", "near", (-F.col("f.less")).alias("best"), "f.name")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last word of its chain; ``forms`` has ``word`` and ``form``, and no circles.

    Every round follows twice as many forms as the one before. A form is ``SHARE`` times as frequent as its word, so chains
    have at most the decimal logarithm of the largest count.
    """
    found = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = found.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        found = stage(found, "roots")
        if found.where("moved").isEmpty():
            return found.select("word", "root")


def groups(words: DataFrame, share: int = SHARE) -> DataFrame:
    """Every word with ``form``, ``root``, ``n``, ``n_near`` and ``form_n``; ``words`` has ``word`` and ``n``."""
    words = stage(words.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    near = near_words(words)
    takes = F.col("best") >= share * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("name")).alias("form"), F.when(takes, F.col("best")).alias("form_n"),
    )
    rows = stage(rows, "spelled")
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
