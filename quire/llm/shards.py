"""Sharding by sampled splitters: shards of near equal bytes.

Records are ordered by (digest of the text, key).  A sample of these order keys, drawn by
hash in proportion to size, gives quantile splitters; records are range-partitioned by them,
and ranges that turn out overfull are subdivided with splitters from a denser sample of
their own records.  Exact sums over the ranges then give every record its place in the
order, and a shard is an equal part of all bytes.

Equal texts stay in one shard as long as their group is small against a shard
(``TOLERANCE``); larger groups are cut, so no group makes shards unequal.

Defined cases: a null text has no bytes and equals the empty text; null keys sort first;
repeated rows are counted before the shuffle and expanded at the end in chunks, each with a slot of
its own; an empty input gives an empty result.  Only the key and the text are read.
Everything is DataFrame operations on rows without texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import table, written

SHARDS = 40
OVERHEAD = 16       # bytes that a record counts beside its text
TOLERANCE = 100     # a group is cut when it has more than a shard's bytes / TOLERANCE
RANGES = 160        # ranges asked for, at least
RANGE_BYTES = 256 << 20  # bytes of texts in a range: beyond RANGES of these there are more ranges
SAMPLED = 32        # records sampled at a time for each range, about
CHUNK = 1000        # copies of a record that one row is expanded to
TASK_COPIES = 1_000_000  # copies that a task expands, about
ROUNDS = 6          # times that overfull ranges are subdivided, at most

Bound = tuple[str, int | None]


def _before(bound: Bound) -> Column:
    """Does a record come before a splitter?  A splitter without a key stands before its group."""
    digest, sub = bound
    if sub is None:
        return F.col("digest") < digest
    return (F.col("digest") < digest) | ((F.col("digest") == digest)
                                         & (F.col("sub").isNull() | (F.col("sub") < sub)))


def place(bounds: list[Bound], first: int = 0) -> Column:
    """How many of the ordered splitters a record has reached, by bisection."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(_before(bounds[mid]), place(bounds[:mid], first)) \
        .otherwise(place(bounds[mid + 1:], first + mid + 1))


def _order(bound: Bound) -> tuple:
    return bound[0], bound[1] is not None, bound[1] or 0


def _sample(rows: DataFrame, total: float, wanted: int, ranges: int) -> list[Bound]:
    """Order keys drawn by a hash, in proportion to weight; the same on every run."""
    unit = F.xxhash64("digest", "key") / F.lit(2.0 ** 64) + 0.5
    drawn = rows.where(unit < F.col("weight") * (SAMPLED * ranges / max(total, 1.0))).select("digest", "sub")
    keys = sorted(((r[0], r[1]) for r in drawn.limit(8 * SAMPLED * ranges).collect()), key=_order)
    return [keys[k * len(keys) // wanted] for k in range(1, wanted)] if keys else []


def splitters(rows: DataFrame, total: float, ranges: int = RANGES) -> tuple[list[Bound], list]:
    """Splitters, and the exact totals of the ranges that they make (a few times ``ranges``)."""
    bounds = sorted(set(_sample(rows, total, ranges, ranges)), key=_order)
    for _ in range(ROUNDS):
        sums = rows.groupBy(place(bounds).alias("range")).agg(
            F.sum("weight").alias("weight"), F.sum(F.col("size") * F.col("copies")).alias("bytes"),
            F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("units")).orderBy("range").collect()
        full = [r for r in sums if r["weight"] > 2 * total / ranges and r["units"] > 1]
        if not full:
            break
        over = rows.where(place(bounds).isin([r["range"] for r in full]))
        weight = sum(r["weight"] for r in full)
        more = _sample(over, weight, int(-(-2 * weight * ranges // total)), ranges)
        if set(more) <= set(bounds):
            break
        bounds = sorted({*bounds, *more}, key=_order)
    return bounds, sums


def expanded(rows: DataFrame) -> DataFrame:
    """Every row ``copies`` times, numbered by ``copy``; those of many copies in chunks that are
    dealt over tasks."""
    many = rows.where(F.col("copies") > CHUNK)
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, (many.agg(F.sum("copies")).first()[0] or 0) // TASK_COPIES)
    chunks = many.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK)))) \
        .repartition(tasks, "digest", "key", "chunk")
    first = F.col("chunk") * CHUNK
    chunks = chunks.withColumn("copy", F.explode(F.sequence(first, F.least(first + CHUNK, "copies") - 1))).drop("chunk")
    few = rows.where(F.col("copies") <= CHUNK)
    return few.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).unionByName(chunks)


def shard(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every row."""
    spark = df.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(key).cast("long").alias("key"), (F.octet_length(body).cast("long") + OVERHEAD).alias("size"),
                     F.crc32(body.cast("binary")).alias("crc"), F.md5(body.cast("binary")).alias("digest"))
    rows = written(rows.groupBy("key", "digest", "size", "crc").agg(F.count(F.lit(1)).alias("copies")), "records")
    total, count = rows.agg(F.sum(F.col("size") * F.col("copies")), F.sum("copies")).first()
    if not total:
        return spark.createDataFrame([], "key long, size long, crc long, shard int, slot long") \
            .withColumnsRenamed({"key": key, "crc": "text_crc32"})
    # Their sizes add up to at most all bytes, so there are at most shards * TOLERANCE large groups.
    large = rows.groupBy("digest").agg(F.sum(F.col("size") * F.col("copies")).alias("s")) \
        .where(F.col("s") * (shards * TOLERANCE) > total).select("digest", F.lit(True).alias("large"))
    rows = rows.join(F.broadcast(large), "digest", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    # A record weighs its bytes and an equal share, so that neither bytes nor rows pile up in a range.
    rows = written(rows.withColumns({"sub": F.when(F.col("large"), F.col("key")),
                                     "weight": (F.col("size") + total / count) * F.col("copies")}), "weighed")
    bounds, sums = splitters(rows, 2.0 * total, max(RANGES, -(-total // RANGE_BYTES)))
    starts, at, n = [], 0, 0
    for r in sums:
        starts.append((r["range"], at, n))
        at, n = at + r["bytes"], n + r["rows"]
    starts = spark.createDataFrame(starts, "range int, bytes_before long, rows_before long")
    ranged = rows.withColumn("range", place(bounds)).join(F.broadcast(starts), "range")
    order = Window.partitionBy("range").orderBy("digest", F.col("key").asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranged = ranged.withColumns({
        "start": F.col("bytes_before") + F.coalesce(F.sum(F.col("size") * F.col("copies")).over(before), F.lit(0)),
        "index": F.col("rows_before") + F.coalesce(F.sum("copies").over(before), F.lit(0))})
    ranged = ranged.withColumn("group_start", F.min("start").over(Window.partitionBy("range", "digest")))
    each = expanded(written(ranged, "ranged"))
    begin = F.when(F.col("large"), F.col("start") + F.col("copy") * F.col("size")).otherwise(F.col("group_start"))
    placed = each.select("key", "size", "crc", (F.col("index") + F.col("copy")).alias("index"), begin.alias("begin"))
    placed = written(placed.withColumn("shard", F.expr(f"cast(begin * {shards}L div {total}L as int)")), "placed")
    firsts = placed.groupBy("shard").agg(F.min("index").alias("first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("index") - F.col("first")).alias("slot"))


def op5_shards(spark, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


#: The same law over one global order.
OP5_SQL = f"""
WITH crc AS (
  SELECT list_transform(generate_series(0, 255), lambda i: list_reduce(list_prepend(i, generate_series(1, 8)),
           lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, coalesce(text, '') AS body, md5(coalesce(text, '')) AS digest,
         CAST(octet_length(encode(coalesce(text, ''))) + {OVERHEAD} AS BIGINT) AS size FROM documents),
g AS (
  SELECT *, CAST(sum(size) OVER () AS BIGINT) AS total, CAST(sum(size) OVER (PARTITION BY digest) AS BIGINT) AS mass,
         CAST(sum(size) OVER (ORDER BY digest, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM d),
s AS (
  SELECT *, CAST((CASE WHEN mass * {SHARDS * TOLERANCE} > total THEN start
                  ELSE min(start) OVER (PARTITION BY digest) END) * {SHARDS} // total AS INT) AS shard FROM g)
SELECT doc_id, size,
       CAST(xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
         list_transform(generate_series(1, 2 * octet_length(encode(body)) - 1, 2),
                        lambda i: CAST('0x' || hex(encode(body))[i:i + 1] AS BIGINT))),
         lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS BIGINT) AS text_crc32,
       'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY digest, doc_id NULLS FIRST) - 1 AS slot,
       CAST(NULL AS INT) AS grown_shard
FROM s, crc
"""
