"""Row numbers and first-n rows of a total order, without a one-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.session import stored

#: Ranges counted in one pass, rows sampled for their bounds, and rows few enough to be sorted by the driver.
RANGES, SAMPLE, FEW = 32, 2_000, 4_096

#: ``monotonically_increasing_id`` has the partition above these bits, the place in it below.
_PLACE_BITS = 33


def numbered(df: DataFrame, order: list[Column], name: str = "n",
             within: list[str] | None = None) -> tuple[DataFrame, int]:
    """(``df`` with its row numbers 1, 2, ... in ``order`` as ``name``, number of rows).

    One range shuffle: each task sorts its range and numbers its rows; the
    rows before a range are the sum of the ranges before it (one row a task).
    Rows equal in ``order`` are told apart by their place in ``df``, so a value
    that very many rows share is spread over tasks.  ``df`` should be a stored
    table, as range bounds are sampled from it first.

    With ``within`` each combination of those columns is numbered from 1 by
    itself; a key of many rows lies in many ranges and is summed over them.
    """
    keys = list(within or [])
    tie, at, part = f"{name}__tie", f"{name}__at", f"{name}__part"
    first = [F.col(f"`{k}`").asc_nulls_first() for k in keys]
    rows = df.withColumn(tie, F.monotonically_increasing_id())
    sort = [*first, *order, F.col(tie)]
    ranged = rows.repartitionByRange(*sort).sortWithinPartitions(*sort).drop(tie)
    placed = stored(ranged.withColumn(at, F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn(part, F.shiftright(F.col(at), _PLACE_BITS))
    of = [F.col(f"`{k}`").alias(f"{name}__{i}") for i, k in enumerate(keys)]
    sizes = placed.groupBy(part, *of).agg(F.count(F.lit(1)).alias("rows"), F.min(at).alias("start"))
    before = (Window.partitionBy(*[f"{name}__{i}" for i in range(len(keys))]).orderBy(part)
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = stored(sizes.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("start") + 1)
                    .withColumnsRenamed({"before": f"{name}__before", part: f"{name}__of"}).drop("start"), "starts")
    total = starts.agg(F.sum("rows")).first()[0] or 0
    on = F.col(part) == F.col(f"{name}__of")
    for i, k in enumerate(keys):
        on = on & F.col(f"`{k}`").eqNullSafe(F.col(f"{name}__{i}"))
    out = placed.join(starts.drop("rows"), on).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col(at) + F.col(f"{name}__before")).alias(name))
    return out, total


def _key(columns: list[str], schema, row=None) -> Column:
    """The columns as one value (nulls smallest), of each row or of ``row``."""
    if row is None:
        return F.struct(*[F.col(f"`{c}`").alias(c) for c in columns])
    return F.struct(*[F.lit(v).cast(schema[c].dataType).alias(c) for c, v in zip(columns, row)])


def _nth_value(df: DataFrame, size: int, n: int, ranges: int, sample: int, few: int) -> tuple[object, int]:
    """(the n-th value of the one column of ``df``, which has ``size`` rows, nulls
    first; the number of rows below it), by passes of range counts (``nth_row``)."""
    columns, schema = df.columns, df.schema
    in_order = F.col(f"`{columns[0]}`").asc_nulls_first()
    key, at = _key(columns, schema), lambda row: _key(columns, schema, row)
    before, low, high = 0, None, None
    while True:
        inside = df if low is None else df.where(key > at(low))
        inside = inside if high is None else inside.where(key < at(high))
        if size <= few:
            rows = inside.orderBy(in_order).collect()
            row = rows[n - before - 1]
            return row[0], before + rows.index(row)
        seen = inside.sample(fraction=min(1.0, sample / size), seed=size).distinct().orderBy(in_order).collect()
        if not seen:  # a sample can come out empty; any row will do as a bound
            seen = inside.take(1)
        bounds = seen[len(seen) // ranges // 2::max(1, len(seen) // ranges)]
        counts = inside.agg(*[F.count_if(c) for b in bounds for c in (key < at(b), key <= at(b))]).first()
        lower, upper = 0, size
        for bound, less, up_to in zip(bounds, counts[::2], counts[1::2]):
            if n > before + up_to:
                low, lower = bound, up_to
            elif n > before + less:
                return bound[0], before + less
            else:
                high, upper = bound, less
                break
        size, before = upper - lower, before + lower


def nth_row(df: DataFrame, n: int, ranges: int = RANGES, sample: int = SAMPLE,
            few: int = FEW) -> tuple[tuple, int] | None:
    """(the n-th row of ``df`` ordered by its columns from left to right, nulls
    first; the number of rows before those equal to it), or None without one.

    Column by column: the n-th value of the first column, then, among the rows
    that have it, the value of the second, and so on.  A pass over a column
    reads that column alone, so what makes the others (a join, say) is not
    worked out for every row in every pass, and a filter on the columns found
    is one on single columns, which the planner moves below a join.

    A column's value is found by passes of range counts: bounds are quantiles
    of a small sample of the range still open; one aggregate counts the rows
    below and up to each bound, in partial sums; the range that holds the n-th
    row is open in the next pass.  A pass leaves about 1 / ``ranges`` of the
    rows and never the bounds themselves, so it ends on any ties.  A task
    counts its own rows, and one task sees a row of counts from each.  The
    sample only places the bounds, so the result is exact whatever it holds.
    """
    columns, schema = df.columns, df.schema
    inside, found, before = df, [], 0
    for i, c in enumerate(columns):
        size = inside.count()
        if not 1 <= n - before <= size:
            return None
        if size <= few:
            rest = [F.col(f"`{x}`") for x in columns[i:]]
            rows = inside.select(*rest).orderBy(*[x.asc_nulls_first() for x in rest]).collect()
            row = rows[n - before - 1]
            return (*found, *row), before + rows.index(row)
        value, less = _nth_value(inside.select(F.col(f"`{c}`")), size, n - before, ranges, sample, few)
        found, before = [*found, value], before + less
        inside = inside.where(F.col(f"`{c}`").eqNullSafe(F.lit(value).cast(schema[c].dataType)))
    return tuple(found), before


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows of ``df`` by ``order`` (ascending, nulls first; ties
    by the other columns): a filter on the n-th row, which ``nth_row`` finds by
    jobs of its own.  Rows equal to it in all columns are made as often as they
    belong to the first ``n``."""
    columns = list(order) + [c for c in df.columns if c not in order]
    rows = df.select(*[F.col(f"`{c}`") for c in columns])
    found = nth_row(rows, n)
    if found is None:
        return df if n > 0 else df.where(F.lit(False))
    row, before = found
    key = _key(columns, rows.schema)
    same = df.sparkSession.range(n - before).select(
        *[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(columns, row)])
    # follows from the filter on all columns; on one alone, it goes below a join that makes the others
    lead, value = F.col(f"`{columns[0]}`"), F.lit(row[0]).cast(rows.schema[columns[0]].dataType)
    near = rows.where(lead.isNull() if row[0] is None else lead.isNull() | (lead <= value))
    return (near.where(key < _key(columns, rows.schema, row)).unionByName(same)
            .select(*[F.col(f"`{c}`") for c in df.columns]))
