"""Joining a many-rows side to a lookup that is unique on the key, with hot keys split off.

Resolving natural keys to ids (edition -> work, ref -> work/author) joins a large
side, where one key may carry a large share of the rows (a work with a third of all
editions, an author credited on a third of all works), to a lookup with one row per
key.  A plain shuffle join sends all rows of such a key to one task.

``lookup_join`` counts rows per hash of the key first (a bounded number of counts, whatever the
number of keys), then per key among the few hashes that hold enough rows, takes the keys above the
average partition size -- at most ``max_hot`` of them, a proven bound -- and joins their rows against a broadcast of
just those lookup rows; every other key goes through the normal shuffle join.  The
result equals ``df.join(lookup, key, how)``.  AQE's skew-join splitting stays
enabled as a second line of defence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


HOT_ROWS = 10_000     # rows of a key below which splitting it off is not worth a second join
HASHES = 4_096        # counts by which hot keys are looked for, at least


def hot_keys(df: DataFrame, key: str, max_hot: int | None = None, min_rows: int = HOT_ROWS) -> list:
    """Keys holding more rows than an average shuffle partition (and ``min_rows``).

    Rows are counted per hash of the key, so what is shuffled and brought to the driver is bounded by the
    number of hashes; a hot key makes its hash hot, so exact counts per key are needed of the hot
    hashes' rows only, a second job that mostly does not run.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    max_hot = max_hot or parts
    hashes = max(HASHES, 16 * parts)
    hashed = F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(hashes)))
    counts = df.groupBy(hashed.alias("_h")).agg(F.count(F.lit(1)).alias("_c")).collect()
    threshold = max(sum(r["_c"] for r in counts) / parts, min_rows)
    full = [r["_h"] for r in counts if r["_h"] is not None and r["_c"] > threshold]
    if not full:
        return []
    per_key = df.where(hashed.isin(full)).groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    top = per_key.where(F.col("_c") > threshold).orderBy(F.col("_c").desc()).limit(max_hot).collect()
    return [r[key] for r in top]


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, how: str = "inner",
                max_hot: int | None = None, min_rows: int = HOT_ROWS, hot: list | None = None) -> DataFrame:
    """``df.join(lookup, key, how)`` for a ``lookup`` unique on ``key``, hot keys split off.

    ``hot`` may be given when it was found on a cheaper, already written input with
    the same key distribution (e.g. the Parquet the rows were derived from).
    """
    if hot is None:
        hot = hot_keys(df, key, max_hot, min_rows)
    if not hot:
        return df.join(lookup, key, how)
    spark = df.sparkSession
    hot_df = spark.createDataFrame([(k,) for k in hot], df.select(key).schema)
    hot_lookup = lookup.join(F.broadcast(hot_df), key, "left_semi")           # <= len(hot) rows
    hot_rows = df.join(F.broadcast(hot_df), key, "left_semi")
    cold_rows = df.join(F.broadcast(hot_df), key, "left_anti")
    return (cold_rows.join(lookup, key, how)
            .unionByName(hot_rows.join(F.broadcast(hot_lookup), key, how)))
