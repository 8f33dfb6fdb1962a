"""Keyed aggregates, top-k and dimension lookups (counts, sums, means, extremes).

All aggregates are algebraic (count/sum/min/max), so Spark plans them as
partial aggregate -> exchange on the key -> final aggregate: a hot key is
combined map-side and never travels as raw rows. Every ordered or limited
output carries the key as the last sort column (deterministic ties, D1).
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- A1/A2/A3: counts -------------------------------------------------------

def value_histogram(df: DataFrame, value: str | Column, name: str = "value") -> DataFrame:
    """A1 ``countByValue``: (value, cnt) for every distinct value."""
    return df.groupBy(_col(value).alias(name)).agg(F.count("*").alias("cnt"))


def count_by_key(df: DataFrame, key: str | Column, name: str | None = None) -> DataFrame:
    """A2/A3: (key, cnt)."""
    k = _col(key).alias(name) if name else _col(key)
    return df.groupBy(k).agg(F.count("*").alias("cnt"))


# --- A4-A7: sums, means, extremes ------------------------------------------

def sum_by_key(df: DataFrame, key: str, value: str | Column, out: str = "total",
               money: bool = True) -> DataFrame:
    """A4: sum per key. ``money`` sums as ``decimal(18,2)`` (exact, order-free, D3)."""
    v = _col(value)
    if money:
        v = v.cast("decimal(18,2)")
    return df.groupBy(key).agg(F.sum(v).alias(out))


def mean_by_key(df: DataFrame, key: str, value: str | Column, out: str = "avg_value",
                mode: str = "truncate") -> DataFrame:
    """A5: mean per key from (sum, count).

    ``truncate`` is the reference's integer division (toward zero, D4) on an
    integral value; ``exact`` is the double mean.
    """
    v = _col(value)
    if mode == "truncate":
        s = df.groupBy(key).agg(F.sum(v.cast("long")).alias("_s"),
                                F.count(v).alias("_n"))
        return s.select(key, F.expr("_s div _n").alias(out))
    if mode == "exact":
        return df.groupBy(key).agg(F.avg(v).alias(out))
    raise ValueError("mode must be 'truncate' or 'exact'")


def extreme_by_key(df: DataFrame, key: str, value: str | Column, how: str = "min",
                   out: str = "value") -> DataFrame:
    """Min or max per key."""
    agg = {"min": F.min, "max": F.max}[how]
    return df.groupBy(key).agg(agg(_col(value)).alias(out))


def argmax(df: DataFrame, value: str, key: str) -> DataFrame:
    """The single (key, value) row with the largest value; ties -> larger key.

    ``max(struct(value, key))`` is one partial+final aggregate (a single
    row per task crosses the network), the reference's tuple max.
    """
    m = df.agg(F.max(F.struct(F.col(value).alias("v"), F.col(key).alias("k"))).alias("_m"))
    return m.where(F.col("_m").isNotNull()).select(
        F.col("_m.k").alias(key), F.col("_m.v").alias(value))


# --- O1-O9: ordering and top-k ----------------------------------------------

def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """``orderBy(...).limit(k)`` -> TakeOrderedAndProject (per-task top-k,
    then a k-row merge); the caller includes the key as a tie-break."""
    return df.orderBy(*order).limit(k)


# --- J4/J5/J6: dimension lookups ---------------------------------------------

def lookup(df: DataFrame, dim: DataFrame, key: str, value: str,
           on_missing: str = "null", broadcast: str | None = None,
           dim_key: str | None = None) -> DataFrame:
    """Attach ``dim.value`` to ``df`` by key (left join).

    ``on_missing``: ``null`` keeps the row with NULL, ``error`` raises
    (the reference's map access, D6), ``drop`` makes it an inner join.

    ``broadcast`` names the side whose size the *caller* has bounded:

    * ``'left'`` (e.g. a top-k result): the distinct keys of ``df`` are
      broadcast into an inner join that streams ``dim`` once without
      shuffling it, and only the matching dimension rows meet ``df``.
      (A left outer join can only build its right side, so hinting the
      left side of it would be ignored.)
    * ``'right'``: a small dimension is broadcast.
    * ``None``: Spark chooses by measured size (AQE turns a join into a
      broadcast at run time only when the shuffle output is small).
    """
    dim_key = dim_key or key
    d = dim.select(F.col(dim_key).alias("_dk"), F.col(value).alias("_dv"))
    if broadcast == "left":
        keys = F.broadcast(df.select(F.col(key).alias("_k")).distinct())
        d = d.join(keys, d["_dk"] == keys["_k"]).select("_dk", "_dv")
    elif broadcast == "right":
        d = F.broadcast(d)
    how = "inner" if on_missing == "drop" else "left"
    j = df.join(d, df[key] == d["_dk"], how)
    v = F.col("_dv")
    if on_missing == "error":
        v = F.coalesce(v, F.raise_error(F.concat(
            F.lit(f"no {value} for {key} "), F.col(key).cast("string"))))
    elif on_missing not in ("null", "drop"):
        raise ValueError("on_missing must be null, error or drop")
    return j.select(*[df[c] for c in df.columns], v.alias(value))


# --- P4/X2: SQL over a temp view -------------------------------------------

def sql_range(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """``SELECT * FROM view WHERE col >= lo AND col <= hi`` via ``spark.sql``.

    Bounds are named arguments of any type; no view outlives the call.
    """
    return df.sparkSession.sql(
        f"SELECT * FROM {{rows}} WHERE `{column}` >= :lo AND `{column}` <= :hi",
        args={"lo": lo, "hi": hi}, rows=df)
