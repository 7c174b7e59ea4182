"""Partitioned JDBC reads of the relational facts.

The original opened one connection on one worker and fetched a whole
table into memory.  Spark's JDBC source instead splits the scan into
``num_partitions`` range queries on a numeric column (or runs one query
per explicit predicate, which ``split_predicates`` makes from a sample of the
keys when they are skewed or text), streams rows with ``fetchsize`` and pushes the
projected columns and filters into each query.

No database is started by this package or its tests; the option builder
is unit-tested and the reader is the stock ``spark.read.jdbc``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from usagelens.sources.files import conform_input


def jdbc_options(url: str, table: str, *, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetchsize: int = 10_000,
                 user: str | None = None, password: str | None = None,
                 driver: str | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetchsize)}
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            opts[key] = value
    return opts


def _literal(value) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, str, date)):
        raise TypeError(f"a split key must be a number, text, date or timestamp, not {type(value).__name__}")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + (value if isinstance(value, str) else str(value)).replace("'", "''") + "'"


def split_predicates(column: str, sample: Iterable, num_partitions: int) -> list[str]:
    """WHERE clauses that cut a table into at most ``num_partitions`` parts of
    about as many rows each, from a sample of the keys in ``column``.

    Bounds are the sample's quantiles, so ids that crowd in one region get
    narrow ranges there, where equal ranges between a lower and an upper
    bound would put nearly all rows into one.  A key that holds several
    parts' rows gets a part of its own; it cannot be cut further.  Every row
    meets exactly one clause; nulls are with the first.  The database has to
    order the column as Python does (for text: by code point).
    """
    keys = sorted(k for k in sample if k is not None)
    if num_partitions < 1:
        raise ValueError("num_partitions must be at least 1")
    if not keys:
        return ["1 = 1"]
    cuts = []
    for i in range(1, num_partitions):
        key = keys[i * len(keys) // num_partitions]
        if key != keys[0] and key not in cuts[-1:]:
            cuts.append(key)
    # a key whose run of the sample covers a whole part ends its part, too
    for key in list(cuts) + [keys[0]]:
        after = bisect_right(keys, key)
        if (after - bisect_left(keys, key)) * num_partitions >= len(keys) and after < len(keys):
            cuts.append(keys[after])
    cuts = [_literal(k) for k in sorted(set(cuts))]
    if not cuts:
        return ["1 = 1"]
    return ([f"{column} < {cuts[0]} OR {column} IS NULL"]
            + [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
            + [f"{column} >= {cuts[-1]}"])


def read_jdbc(spark: SparkSession, name: str, url: str, table: str | None = None,
              predicates: list[str] | None = None, properties: dict | None = None,
              **options) -> DataFrame:
    """Read input ``name`` (e.g. ``"voice_call_record"``) from ``table``
    (default: the same name) and conform it to the declared schema.
    ``predicates`` gives one partition per WHERE clause (``split_predicates``
    makes them from a sample of keys)."""
    table = table or name
    if predicates:
        props = dict(properties or {})
        props.setdefault("fetchsize", str(options.pop("fetchsize", 10_000)))
        df = spark.read.jdbc(url, table, predicates=predicates, properties=props)
    else:
        df = spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
    return conform_input(df, name)
