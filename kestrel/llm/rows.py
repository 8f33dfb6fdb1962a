"""Names for rows that do not depend on files, partitions or cores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_digest(columns: list[str]) -> Column:
    """MD5 of all ``columns`` as text; null differs from the empty text."""
    parts = [F.coalesce(F.md5(F.col(f"`{c}`").cast("string").cast("binary")), F.lit("-"))
             for c in columns]
    return F.md5(F.concat_ws(",", *parts).cast("binary"))


def ordinals(rows: DataFrame, row_col: str, digest_col: str) -> DataFrame:
    """(row_col, ordinal): numbers the rows of each digest from 1.

    ``row_col`` is a ``monotonically_increasing_id``. Rows are numbered within
    their partition, and the counts of the partitions before are added, so no
    task sees all rows of a digest."""
    part = F.shiftright(row_col, 33)
    d = rows.select(row_col, digest_col, part.alias("__part"))
    cell = Window.partitionBy(digest_col, "__part").orderBy(row_col)
    counts = d.groupBy(digest_col, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(digest_col).orderBy("__part")
    counts = counts.withColumn("__before", F.sum("__n").over(before) - F.col("__n"))
    return (d.withColumn("__at", F.row_number().over(cell))
            .join(counts, [digest_col, "__part"])
            .select(row_col, (F.col("__before") + F.col("__at")).alias("ordinal")))
