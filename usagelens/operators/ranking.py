"""Top-k / least-k lists, positional ranks and the rank-keyed merge.

* ``top_k`` numbers rows 1..k per series with ``row_number`` (ties get
  distinct positions, broken by name) and keeps ranks <= k.  Spark plans
  the filter as ``WindowGroupLimit``: every partition keeps only its own
  best k per series *before* the shuffle, so the final window sorts at
  most k x partitions rows per series — never a whole input.
* ``merge_ranks`` is the original 10-way / 4-way join on rank: one
  pivot on rank; a series shorter than the longest one gets the fill
  label for its missing ranks; no input rows -> no output rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP = "top"
LEAST = "least"


def top_k(counts: DataFrame, k: int = 5, descending: bool = True,
          partition_cols: list[str] | None = None, count_col: str = "n",
          name_col: str = "name") -> DataFrame:
    """(partition_cols..., rank, name_col): the k largest (or smallest)
    ``count_col`` per partition, ties by name ascending."""
    partition_cols = list(partition_cols or [])
    by_count = F.col(count_col).desc() if descending else F.col(count_col).asc()
    window = Window.partitionBy(*partition_cols).orderBy(by_count, F.col(name_col).asc_nulls_last())
    return (counts.withColumn("rank", F.row_number().over(window))
            .where(F.col("rank") <= k)
            .select(*partition_cols, F.col("rank").cast("long").alias("rank"), name_col))


def top_and_least(counts: DataFrame, k: int, series_col: str, name_col: str,
                  count_col: str = "n") -> DataFrame:
    """Both directions per series -> (series, rank, name) where ``series``
    becomes ``top_<s>`` / ``least_<s>``."""
    out = None
    for direction, descending in ((TOP, True), (LEAST, False)):
        ranked = top_k(counts, k, descending, [series_col], count_col, name_col)
        ranked = ranked.select(
            F.concat(F.lit(direction + "_"), F.col(series_col)).alias(series_col), "rank", name_col)
        out = ranked if out is None else out.unionByName(ranked)
    return out


def merge_ranks(ranked: DataFrame, series_col: str, name_col: str,
                columns: dict[str, str], fill: str | None) -> DataFrame:
    """Pivot (series, rank, name) into one row per rank with one column per
    series (``columns`` maps series value -> output column)."""
    wide = ranked.groupBy("rank").pivot(series_col, list(columns)).agg(F.max(name_col))
    out = wide.select(F.col("rank").cast("long").alias("rank"),
                      *[F.col(f"`{s}`").alias(c) for s, c in columns.items()])
    if fill is not None:
        out = out.na.fill(fill, subset=list(columns.values()))
    return out
