"""Numbering rows without a single-task sort: W1 (rank within a group) and M6 (ids).

``rank_within_groups`` numbers rows 1..n inside each group in a given order: one shuffle by
group and a window.  Groups with more rows than an average partition are split off first (there are
at most as many as partitions): their rows are range-partitioned on ``(group, order)``, so a hot group
is spread over many partitions; each partition is sorted locally and numbered by
``monotonically_increasing_id``; per (partition, group) counts give each piece its offset.  Those
numbered rows are written to the shared scratch folder before they are counted and joined, so both uses
see the same numbers even if a task is retried.

``assign_ids`` gives dense ids ``start + 1 ..`` to rows with a unique key: rows are
hashed into buckets, numbered inside their bucket in key order, and shifted by the
running total of earlier buckets (one small row per bucket, broadcast).  Every
step is a pure function of the key, so a recomputation yields the same ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.joins import HOT_ROWS, hot_keys
from quire.sources.tables import materialize


def _partitions(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rank_within_groups(df: DataFrame, group: str, order: str, out: str = "rn",
                       start: DataFrame | None = None, num_partitions: int | None = None,
                       path: str | None = None, min_rows: int = HOT_ROWS) -> DataFrame:
    """Row number of each row within ``group`` ordered by ``order`` (1-based).

    ``(group, order)`` must be unique; rows without a group drop out.  ``start`` is an optional
    ``(group, start)`` DataFrame whose value is added to every number of that group (W1 + B7).  ``path``
    names the folder of the numbered copy of hot groups (those of over ``min_rows`` rows and an average
    partition), so that a caller can remove it.  ``df`` is read once to find them: it should be written.
    """
    columns, df = df.columns, df.where(F.col(group).isNotNull())
    if start is not None:
        start = start.select(F.col(start.columns[0]).alias(group), F.col(start.columns[1]).alias("_start"))
    hot = hot_keys(df, group, min_rows=min_rows)
    if not hot:
        return _rank_by_window(df, group, order, out, start).select(*columns, out)
    names = F.broadcast(df.sparkSession.createDataFrame([(g,) for g in hot], df.select(group).schema))
    few = None if start is None else start.join(names, group, "left_semi")
    return (_rank_by_window(df.join(names, group, "left_anti"), group, order, out, start).select(*columns, out)
            .unionByName(_rank_by_range(df.join(names, group, "left_semi"), group, order, out, few,
                                        _partitions(df, num_partitions), path).select(*columns, out)))


def _started(df: DataFrame, group: str, start: DataFrame | None, number: str) -> DataFrame:
    """``number`` raised by the group's start."""
    if start is None:
        return df
    return df.join(start, group, "left").withColumn(number, F.col(number) + F.coalesce(F.col("_start"), F.lit(0)))


def _rank_by_window(df: DataFrame, group: str, order: str, out: str, start: DataFrame | None) -> DataFrame:
    number = F.row_number().over(Window.partitionBy(group).orderBy(order)).cast("bigint")
    return _started(df.withColumn(out, number), group, start, out)


def _rank_by_range(df: DataFrame, group: str, order: str, out: str, start: DataFrame | None, p: int,
                   path: str | None) -> DataFrame:
    numbered = materialize(df.repartitionByRange(p, F.col(group), F.col(order))
                           .sortWithinPartitions(group, order)
                           .withColumn("_mid", F.monotonically_increasing_id())
                           .withColumn("_pid", F.shiftright("_mid", 33)), path)
    pieces = numbered.groupBy("_pid", group).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = _started(pieces.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), group, start, "_before")
    # At most one row a partition and hot group.
    return (numbered.join(F.broadcast(pieces.select("_pid", group, "_first", "_before")), ["_pid", group])
            .withColumn(out, F.col("_mid") - F.col("_first") + F.col("_before") + 1))


def assign_ids(df: DataFrame, keys: list[str] | str, start: int, out: str = "id",
               num_buckets: int | None = None) -> DataFrame:
    """M6: dense ids ``start+1 .. start+n`` for rows with a unique ``keys``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    b = _partitions(df, num_buckets)
    bucketed = df.withColumn("_b", F.pmod(F.xxhash64(*keys), F.lit(b)))
    numbered = bucketed.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(*keys)))
    sizes = bucketed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    # At most `b` rows: one per bucket.
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(
        Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (numbered.join(F.broadcast(offsets), "_b")
            .select(*df.columns, (F.lit(int(start)) + F.col("_off") + F.col("_r")).cast("bigint").alias(out)))


def max_id(df: DataFrame, col: str = "id") -> int:
    """Largest existing id (0 for an empty table); a one-column aggregate."""
    v = df.agg(F.max(col)).first()[0]
    return int(v) if v is not None else 0
