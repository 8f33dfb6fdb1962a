"""Collection and conditional column functions (the worksheets' list, map,
match and higher-order examples), applied per row of a table.

Arrays are built per row from the row's own columns, so their size is fixed
and nothing is gathered across rows. Function arguments are Python callables
over Columns (``F.transform`` lambdas), evaluated on the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def square(x: Column) -> Column:
    return x * x


def cube(x: Column) -> Column:
    return x * x * x


def halve(x: Column) -> Column:
    """Integer halving (``x / 2`` on ints, truncating toward zero)."""
    return ((x - x % 2) / 2).cast("long")


def apply_fn(c: Column, f: Callable[[Column], Column]) -> Column:
    """Apply a function given as an argument."""
    return f(c)


def array_sum(arr: Column) -> Column:
    """reduce with +."""
    return F.aggregate(arr, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))


def head(arr: Column) -> Column:
    """first element (NULL when empty)."""
    return F.get(arr, 0)


def tail(arr: Column) -> Column:
    """all but the first element."""
    return F.slice(arr, 2, F.greatest(F.size(arr) - 1, F.lit(0)))


def match_label(c: Column, cases: dict, default: str) -> Column:
    """value match with a default (chained CASE WHEN)."""
    out = None
    for k, v in cases.items():
        out = (F.when(c == F.lit(k), F.lit(v)) if out is None
               else out.when(c == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def literal_map(pairs: dict) -> Column:
    """a map literal."""
    kv = []
    for k, v in pairs.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def lookup_or(m: Column, key: Column, default: str) -> Column:
    """lookup with a default for a missing key."""
    return F.coalesce(F.try_element_at(m, key), F.lit(default))
