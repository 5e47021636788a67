"""Column expressions. All of them are built-in Spark functions: no Python runs on the executors.

The longer ones are written as SQL lambdas. One text is parsed once, while the same tree put together from Python takes
hundreds of calls into the JVM each time a query is built.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)

EMPTY_STRINGS = "CAST(array() AS ARRAY<STRING>)"


def strip(text: Column) -> Column:
    """Remove any Unicode white space from both ends."""
    return F.trim(text, F.lit(WHITESPACE))


def bind(name: str, value: str, body: str) -> str:
    """SQL text that evaluates ``value`` once per row and calls it ``name`` in ``body``.

    The name is the variable of a one-element ``transform``, so the optimizer cannot copy the value to every place of
    use when it merges projections.
    """
    return f"transform(array({value}), {name} -> {body})[0]"


def apply(value: Column, name: str, body: str) -> Column:
    """As ``bind``, for a value given as a column."""
    return F.get(F.call_function("transform", F.array(value), F.expr(f"{name} -> {body}")), F.lit(0))


def last_wins_map(entries: Column) -> Column:
    """array<struct<key,value>> of strings -> map in which the last entry of a repeated key counts."""
    add = "(seen, e) -> map_concat(map_filter(seen, (k, v) -> k <> e.key), map(e.key, e.value))"
    return F.call_function("aggregate", entries, F.expr("CAST(map() AS MAP<STRING, STRING>)"), F.expr(add))
