"""Keyed windows that do not put a hot key into one task.

A plain ``PARTITION BY key ORDER BY position`` sorts every row of a key in one task, which a key
holding a large share of the table turns into the whole job. The helpers here cut the ordered axis
(time, offset) of every key into slices of fixed width and partition by ``(key, slice)``. What a
slice needs to know about earlier ones is one row per ``(key, slice)``, aggregated map-side, so the
only window over a whole key runs over its slices, not its rows. The plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"


def slice_start(position: Column, width: int) -> Column:
    """Start of the slice that holds ``position``; exact for any long."""
    return position - F.pmod(position, F.lit(width))


def previous_value(
    rows: DataFrame,
    key: str,
    position: str,
    order: Sequence[str],
    value: str,
    width: int,
    out: str = "previous",
) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY key ORDER BY order)`` for a ``value`` without nulls.

    ``position`` is the numeric axis that is cut into slices of ``width``; it must be the leading
    order column (or grow with it). All rows are dealt out once, by key and slice. Only the first row
    of a slice then lacks its predecessor, which is the last row of the key's slice before.
    """
    cut = rows.withColumn(SLICE, slice_start(F.col(position), width))
    inside = Window.partitionBy(key, SLICE).orderBy(*order)
    seen = cut.withColumns(
        {
            out: F.lag(value).over(inside),
            "_first": F.row_number().over(inside) == 1,
            "_last": F.lead(F.lit(1)).over(inside).isNull(),
        }
    )
    tails = seen.where("_last").select(F.col(key).alias("_slice_key"), F.col(SLICE).alias("_slice_at"), F.col(value).alias("_tail"))
    before = F.lag("_tail").over(Window.partitionBy("_slice_key").orderBy("_slice_at"))
    carried = tails.select("_slice_key", "_slice_at", before.alias("_carried")).where(F.col("_carried").isNotNull())
    columns = [F.col(c) for c in rows.columns]
    # A null key is a key like any other.
    same = F.col(key).eqNullSafe(F.col("_slice_key")) & F.col(SLICE).eqNullSafe(F.col("_slice_at"))
    firsts = seen.where("_first").join(carried, same, "left")
    rest = seen.where(~F.col("_first")).select(*columns, out)
    return firsts.select(*columns, F.col("_carried").alias(out)).unionByName(rest)


def repeat_rows(rows: DataFrame, times: str, chunk: int = 4096) -> DataFrame:
    """Each row ``times`` times, without building one array as long as a huge count."""
    n = F.col(times)
    return (
        rows.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / chunk))))
        .withColumn(
            "_copy",
            F.explode(F.sequence(F.lit(1), F.least(F.lit(chunk), n - F.col("_chunk") * chunk))),
        )
        .drop("_chunk", "_copy")
    )
