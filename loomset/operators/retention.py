"""Which versions a keep-the-newest rule retains."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomset.functions.text import fresh, ref


def retain_last_k(df: DataFrame, group: str, step: str, k: int = 3) -> DataFrame:
    """Add ``expired``: false for the ``k`` newest steps of each group.

    Lists only; nothing is deleted. Steps are unique within a group. Each task
    keeps at most ``k`` rows of a group before the shuffle (a window group
    limit), so a group that holds a large share of all rows costs no more than
    another. Only its oldest retained step is joined back: Spark broadcasts
    those one-per-group rows when their measured size allows, else it uses a
    sort-merge join with skewed partitions split.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k}")
    nth, of, oldest = fresh(df, "nth"), fresh(df, "of_group"), fresh(df, "oldest_kept")
    newest_first = Window.partitionBy(ref(group)).orderBy(ref(step).desc())
    oldest_kept = (
        df.select(ref(group), ref(step))
        .filter(ref(step).isNotNull())
        .withColumn(nth, F.row_number().over(newest_first))
        .filter(F.col(nth) <= k)
        .groupBy(ref(group).alias(of))
        .agg(F.min(ref(step)).alias(oldest))
    )
    joined = df.join(oldest_kept, ref(group).eqNullSafe(F.col(of)), "left")
    kept = F.coalesce(ref(step) >= F.col(oldest), F.lit(False))
    return joined.select(*[ref(c) for c in df.columns], (~kept).alias("expired"))
