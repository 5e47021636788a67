"""Compare a query's rows with those of its SQL, order left aside."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame


def _value(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_value(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _value(x)) for k, x in v.items()))
    return v


def compare(df: DataFrame, rows: list[tuple], con, sql: str) -> str:
    """Empty text when both sides agree; ``rows`` are the collected rows with columns in name order."""
    result = con.sql(sql)
    names = sorted(result.columns)
    if names != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {names}"
    kinds = dict(zip(result.columns, result.types))
    for field in df.schema:
        left, right = field.dataType.simpleString(), str(kinds[field.name]).lower()
        same = {"string": "varchar", "int": "integer"}.get(left, left)
        if "<" not in left and same != right:
            return f"type of {field.name}: {left} != {right}"
    quoted = ", ".join(f'"{n}"' for n in names)
    other = con.sql(f"select {quoted} from ({sql})").fetchall()
    mine = Counter(tuple(_value(v) for v in r) for r in rows)
    theirs = Counter(tuple(_value(v) for v in r) for r in other)
    if mine == theirs:
        return ""
    only_mine, only_theirs = mine - theirs, theirs - mine
    return f"{sum(mine.values())}/{sum(theirs.values())} rows; spark only {list(only_mine)[:2]}; sql only {list(only_theirs)[:2]}"
