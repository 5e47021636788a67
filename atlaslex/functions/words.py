"""Words of a text, and how often each occurs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from atlaslex.functions import apply, bind

# Letters and digits of any script, and the underscore, make up words.
IN_WORD = r"[\p{L}\p{N}_]"
BETWEEN_WORDS = r"[^\p{L}\p{N}_]+"
# The spoken contractions a treebank tokenizer takes apart.
CONTRACTIONS = [("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na")]
# Texts whose words are counted together: their different words stay in a core's cache.
TEXTS_AT_ONCE = 200
_SPLIT_HERE = "|".join(f"{head}(?={tail}(?!{IN_WORD}))" for head, tail in CONTRACTIONS)
CONTRACTION_HEAD = f"(?<!{IN_WORD})(?:{_SPLIT_HERE})"
# Most pages hold no contraction: a plain substring test saves them a regular expression.
_HAS_CONTRACTION = " OR ".join(f"contains(t, '{head}{tail}')" for head, tail in CONTRACTIONS)
_SPLIT_IF_ANY = f"CASE WHEN {_HAS_CONTRACTION} THEN regexp_replace(t, r'{CONTRACTION_HEAD}', '$0 ') ELSE t END"


def _prepared(text: Column) -> Column:
    """Lower case, contractions taken apart."""
    return apply(F.lower(F.coalesce(text, F.lit(""))), "t", _SPLIT_IF_ANY)


def _pieces(text: Column) -> Column:
    """Words and, at the ends, empty strings."""
    return F.split(_prepared(text), BETWEEN_WORDS)


def words(text: Column) -> Column:
    """Lower-case words of ``text`` in order, as array<string>."""
    return F.array_compact(F.transform(_pieces(text), lambda w: F.nullif(w, F.lit(""))))


# Runs of equal words in a sorted array: where they start, and how far apart the starts are. Empty strings sort first and
# equal the stand-in for "no word before", so they start no run.
_STARTS = """
filter(sequence(0, size(ordered) - 1), i -> get(ordered, i) <> coalesce(get(ordered, i - 1), ''))
"""
_RUNS = """
transform(starts, (start, i) -> named_struct(
  'word', get(ordered, start),
  'tf', CAST(coalesce(get(starts, i + 1), size(ordered)) - start AS BIGINT)))
"""


def word_counts(text: Column) -> Column:
    """array<struct<word:string, tf:bigint>>: each distinct word of ``text`` with its count.

    The words are sorted within the row and counted as the distance between the starts of equal runs. An article is one
    row, so no shuffle is needed to count its words.
    """
    return apply(F.sort_array(_pieces(text)), "ordered", bind("starts", _STARTS, _RUNS))


# What the bytes of ASCII texts become: characters between words are blanks. Bytes of other characters stay.
_BLANKED = np.array([b if b > 127 or chr(b).isalnum() or chr(b) == "_" else 32 for b in range(256)], dtype=np.uint8)
# Other characters between words are for Spark to find, in texts that have any.
_BLANK_OTHERS = r"CASE WHEN octet_length(t) = char_length(t) THEN t ELSE regexp_replace(t, r'[^\x00-\x7F\p{L}\p{N}]+', ' ') END"


def _blanked(texts: pa.Array) -> pa.Array:
    """Texts with blanks for all ASCII characters between words."""
    valid, offsets, data = texts.buffers()
    if data is None:
        return texts
    return pa.Array.from_buffers(texts.type, len(texts), [valid, offsets, pa.py_buffer(_BLANKED[np.frombuffer(data, np.uint8)])], offset=texts.offset)


def _counted(texts: pa.Array) -> pa.Array:
    """Words of texts, a blank between them, and how often each occurs in its text."""
    texts = _blanked(texts)
    parts = [_counted_at_once(texts.slice(at, TEXTS_AT_ONCE)) for at in range(0, max(len(texts), 1), TEXTS_AT_ONCE)]
    return pa.concat_arrays(parts)


def _counted_at_once(texts: pa.Array) -> pa.Array:
    pieces = pc.ascii_split_whitespace(texts)
    coded = pieces.flatten().dictionary_encode()
    code, known = coded.indices.to_numpy(), max(len(coded.dictionary), 1)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(pieces).to_numpy())
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    found, tf = np.unique((row * known + code)[code != empty], return_counts=True)
    row, code = np.divmod(found, known)
    offsets = pa.array(np.searchsorted(row, np.arange(len(texts) + 1)), pa.int32())
    words = pa.ListArray.from_arrays(offsets, coded.dictionary.take(pa.array(code)))
    return pa.StructArray.from_arrays([pc.binary_join(words, " "), pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64()))], ["words", "tfs"])


def joined_bag(text: Column) -> Column:
    """struct<words:string, tfs:array<bigint>>: each distinct word of ``text``, a blank between them, and its count, in no order.

    As ``word_counts``, for tables that keep the words of a page in one row: as one string they are written and read at once.
    Spark finds the letters, an Arrow batch of texts is counted at once.
    """
    function = F.arrow_udf(_counted, "words string, tfs array<bigint>").asNondeterministic()
    return function(apply(_prepared(text), "t", _BLANK_OTHERS))


def listed(words: Column) -> Column:
    """array<string>: the words of a ``joined_bag``."""
    return F.when(words == "", F.expr("array()").cast("array<string>")).otherwise(F.split(words, " "))


def word_bag(text: Column) -> Column:
    """struct<words:array<string>, tfs:array<bigint>>: as ``joined_bag``, with the words as an array."""
    return F.transform(F.array(joined_bag(text)), lambda bag: F.struct(listed(bag["words"]).alias("words"), bag["tfs"].alias("tfs")))[0]


def capitalized(word: Column) -> Column:
    """First letter upper case, the rest lower case; a letter whose upper case is two letters (sharp s) keeps one upper."""
    initial = F.upper(F.left(word, F.lit(1)))
    rest = F.concat(F.substring(initial, 2, 9), F.substring(word, 2, 2147483647))
    return F.concat(F.left(initial, F.lit(1)), F.lower(rest))


def code_points(text: Column) -> Column:
    """Distinct characters of ``text``."""
    return F.array_distinct(F.split(F.coalesce(text, F.lit("")), ""))
