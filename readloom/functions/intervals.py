"""Helpers for closed 1-based intervals and for dense histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bases import col, int_div


def bins(start: str | Column, end: str | Column, width: int) -> Column:
    """Array of the numbers of all bins of ``width`` that [start, end] touches."""
    return F.sequence(int_div(col(start), width), int_div(col(end), width))


def dense(
    hist: DataFrame,
    by: list[str],
    key: str,
    value: str,
    low: Column | None = None,
    high: Column | None = None,
) -> DataFrame:
    """Fill the gaps of a histogram with zero rows.

    ``hist`` is already aggregated: one row per (by, key), with an integer key from a
    small range (a Phred score, a percentage, a read position), so the map built per
    group holds at most that range. Default limits: smallest and largest key seen. A
    null key is left out.
    """
    entry = F.when(F.col(key).isNotNull(), F.struct(F.col(key), F.col(value)))
    cells = hist.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_cells"),
        F.min(key).alias("_low"),
        F.max(key).alias("_high"),
    )
    low = F.col("_low") if low is None else low
    high = F.col("_high") if high is None else high
    return cells.withColumn(key, F.explode(F.sequence(low, high))).select(
        *by,
        key,
        F.coalesce(F.element_at("_cells", F.col(key)), F.lit(0).cast("long")).alias(value),
    )


def with_samples(df: DataFrame, samples: DataFrame) -> DataFrame:
    """Repeat every row of ``df`` for each name in ``samples.sample``.

    The names come in as a scalar subquery: one array of sample names, as long as the
    manifest, which passes through one task and the driver. All columns of ``samples`` are
    kept alive, so that a table used elsewhere in the plan as well is computed once.
    """
    whole = F.when(F.hash(*samples.columns).isNotNull(), F.col("sample"))
    names = samples.agg(F.array_sort(F.collect_set(whole)).alias("names")).scalar()
    return df.withColumn("sample", F.explode(names))
