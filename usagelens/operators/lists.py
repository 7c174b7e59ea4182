"""Values of a key as lists of bounded length.

The original's co-group hands every key one list of all its values, which
for a hot key is as long as the fact table.  Here a key has as many lists as
it needs: values are numbered within their key over ranges
(``selection.numbered``), and list ``chunk`` holds the values numbered
``chunk * size + 1`` to ``(chunk + 1) * size``.  No task holds more than its
range, and no list is longer than ``size``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.operators.selection import numbered
from usagelens.session import stored

LIST_SIZE = 1_000


def chunked_lists(df: DataFrame, key: str, value: str, size: int = LIST_SIZE) -> DataFrame:
    """(key, chunk, values): the values of each key in ascending order (nulls
    first, repeats included), cut into lists of ``size``; the last of a key may
    be shorter.  A null key is a key like any other."""
    if size < 1:
        raise ValueError("size must be at least 1")
    rows = stored(df.select(key, value), "pairs")
    placed, _ = numbered(rows, [F.col(f"`{value}`").asc_nulls_first()], "place", within=[key])
    chunk = F.floor((F.col("place") - 1) / size).cast("long")
    # values sit in structs, as lists of bare values leave nulls out
    item = F.struct("place", F.col(f"`{value}`").alias("value"))
    lists = placed.groupBy(key, chunk.alias("chunk")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    return lists.select(key, "chunk", F.col("items.value").alias("values"))
