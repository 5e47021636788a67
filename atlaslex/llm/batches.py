"""Small helpers for operators that work on whole texts in Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, LongType, StructField, StructType

#: Bytes of text that one step of an operator holds, next to the Arrow batch that Spark hands over.
PIECE_BYTES = 2 << 20

UPPER = bytes(range(65, 91))
LOWER_CASE = bytes.maketrans(UPPER, UPPER.lower())
SPACES = b" \t\n\x0b\x0c\r"


def text_bytes(text: str | Column = "text") -> Column:
    """A text column as UTF-8 bytes; null is empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("binary"), F.lit(b""))


def cut(sizes: list[int], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to ``limit`` at most; a larger row is a range of its own."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def arrow_function(fn: Callable[..., pa.Array], kind: DataType):
    """``fn`` over Arrow arrays as a UDF; not deterministic to Spark, so that it is evaluated once for all that read it."""
    # Arrow UDFs are told by their annotations, which must be types and not their names.
    fn.__annotations__ = {name: pa.Array for name in (*fn.__code__.co_varnames[: fn.__code__.co_argcount], "return")}
    return F.arrow_udf(fn, kind).asNondeterministic()


def text_function(schema: DataType, fn: Callable[[list[bytes]], dict[str, Iterable]], piece_bytes: int = PIECE_BYTES):
    """An Arrow UDF from a column of UTF-8 bytes to a struct.

    ``fn`` gets the texts of a piece of about ``piece_bytes`` and returns the values of every field, so the memory of a
    step follows the longest text and not the rows of a batch.
    """
    kind = to_arrow_type(schema)

    def run(texts: pa.Array) -> pa.Array:
        done = [pa.array([], kind)]
        for start, end in cut(pc.binary_length(texts).to_pylist(), piece_bytes):
            found = fn(texts.slice(start, end - start).to_pylist())
            columns = [pa.array(found[field.name], field.type) for field in kind]
            done.append(pa.StructArray.from_arrays(columns, fields=list(kind)))
        return pa.concat_arrays(done)

    return arrow_function(run, schema)


def long_struct(*names: str):
    """A struct of long columns."""
    return StructType([StructField(name, LongType()) for name in names])


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front of each until the table has no such column; Spark does not tell cases apart."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
