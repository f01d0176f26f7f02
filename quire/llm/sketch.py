"""Document fingerprints: bottom-k sketches of word shingles.

A sketch is the sorted array of the k smallest distinct 64-bit shingle hashes of a text.
Sketches of parts merge to the sketch of the whole (``merged``, ``merge_parts``), and pairs
estimate resemblance, containment and the number of distinct shingles; with fewer than k
shingles all of them are exact.

Defined cases: null, empty and blank texts have the empty sketch; two empty sketches are
alike (1), an empty and another are not (0); a text of fewer words than a shingle has one
shingle, the whole text; equal texts have equal sketches.  Everything is an expression on
the row, so repeated rows, nulls and extra columns elsewhere have no effect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import table, unused, written

K = 128
WORDS = 5
RANGE_BYTES = 8 << 20
LEAST_RANGES, MOST_RANGES = 64, 100_000
SAMPLE_PER_RANGE = 20


def with_sketch(df: DataFrame, text: Column, out: str, k: int = K, words: int = WORDS) -> DataFrame:
    """Add the bottom-k sketch of a text.

    The word hashes are a column of their own, used more than once in the next projection,
    so that they are computed once a row."""
    hashes = f"__{out}_words"
    df = df.withColumn(hashes, F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""),
                                           lambda w: F.xxhash64(w)))
    h, n = F.col(hashes), F.size(hashes)
    shingles = F.when(n >= words, F.transform(F.sequence(F.lit(1), n - (words - 1)),
                                              lambda i: F.xxhash64(F.slice(h, i, words)))) \
        .when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<long>"))
    return df.withColumn(out, F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)).drop(hashes)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(df: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """One sketch per key from any number of parts; each task first keeps its own k smallest.  A key whose parts are
    all empty has an empty sketch."""
    each = df.select(key, F.explode_outer(sketch).alias("h")).distinct()
    order = Window.partitionBy(key).orderBy(F.col("h").asc_nulls_last())
    low = each.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)
    return low.groupBy(key).agg(F.sort_array(F.collect_list("h")).alias(sketch))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    kth = (F.element_at(sketch, -1) + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / kth)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of all shingles of two texts that both have."""
    union = F.sort_array(F.array_union(a, b))
    complete = (F.size(a) < k) & (F.size(b) < k)
    seen = F.when(complete, union).otherwise(F.slice(union, 1, k))
    return F.when(F.size(union) == 0, 1.0).otherwise(F.size(F.array_intersect(F.array_intersect(a, b), seen)) / F.size(seen))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second also has."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def as_text(sketch: Column) -> Column:
    """A sketch as base64 of its hashes, eight bytes each."""
    return F.base64(F.unhex(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")))


def reached(x: Column, bounds: list[int]) -> Column:
    """How many of the ordered bounds are at most x, by bisection over a constant array."""
    if not bounds:
        return F.lit(0)
    array = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<long>")
    steps = [1 << p for p in range(len(bounds).bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        (at + step <= len(bounds)) & (F.get(array, at + step - 1) <= x), at + step).otherwise(at))


def key_ranges(rows: DataFrame) -> list[int]:
    """Splitters of key ranges of about RANGE_BYTES, from rows (key, size): quantiles of keys
    that a hash draws in proportion to size."""
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    ranges = int(min(max((total or 0) // RANGE_BYTES, LEAST_RANGES), MOST_RANGES))
    weight, chance = F.col("size") + F.lit((total or 0) / max(count, 1)), ranges * SAMPLE_PER_RANGE / max(2 * (total or 0), 1)
    drawn = rows.where((F.xxhash64("key") / F.lit(2.0 ** 64) + 0.5) < weight * chance).select("key").dropna()
    keys = sorted(r[0] for r in drawn.limit(4 * ranges * SAMPLE_PER_RANGE).collect())
    return sorted({keys[k * len(keys) // ranges] for k in range(1, ranges)}) if keys else []


def with_next(df: DataFrame, key: str, text: str, columns: list[str], derive=lambda rows: rows) -> DataFrame:
    """Add, as ``next_<column>``, values of the next row by descending key (after the last
    row: the first).  Null keys come last; equal keys are ordered by the digest of the text.
    Rows are shuffled once, by key range, after ``derive`` has added its columns; each range
    also gets a copy of the row that follows its last one."""
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    narrow = written(df.select(F.col(key).alias("key"), digest.alias("digest"),
                               F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("size")), "keys")
    bounds = key_ranges(narrow)
    at = lambda c: F.when(c.isNull(), -1).otherwise(reached(c, bounds))
    # The first row of each range, at most MOST_RANGES rows.
    tops = narrow.groupBy(at(F.col("key")).alias("range")).agg(
        F.min(F.struct((-F.col("key")).alias("down"), "digest", "key")).alias("top")).orderBy(F.desc("range")).collect()
    after = [(tops[k]["range"], tops[(k + 1) % len(tops)]["top"]["key"], tops[(k + 1) % len(tops)]["top"]["digest"])
             for k in range(len(tops))]
    at_, ghost, k_, d_ = (unused(df, c) for c in ("range", "ghost", "own_key", "own_digest"))
    ghosts = df.sparkSession.createDataFrame(after, f"{at_} int, {k_} long, {d_} string")
    rows = df.withColumns({at_: at(F.col(key)), ghost: F.lit(False)})
    copies = df.join(F.broadcast(ghosts), F.col(key).eqNullSafe(F.col(k_))).where(digest == F.col(d_)) \
        .withColumn(ghost, F.lit(True)).drop(k_, d_)
    # One range a task: labels that the shuffle's hash sends to a partition each.
    places = [t["range"] for t in tops]
    named = df.sparkSession.createDataFrame(list(zip(places, spread(df.sparkSession, len(places)))), f"{k_} int, {d_} int")
    both = derive(rows.unionByName(copies)).join(F.broadcast(named), F.col(at_) == F.col(k_)).drop(at_, k_) \
        .withColumnRenamed(d_, at_)
    both = both.repartition(max(len(places), 1), at_)
    order = Window.partitionBy(at_).orderBy(ghost, F.col(key).desc_nulls_last(), digest)
    return both.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns}).where(~F.col(ghost)) \
        .drop(at_, ghost)


def spread(spark, parts: int) -> list[int]:
    """``parts`` numbers whose hashes fall into different ones of as many partitions."""
    tries = spark.range(40 * parts + 100).select(F.col("id").cast("int").alias("n"))
    found = tries.groupBy(F.pmod(F.hash("n"), F.lit(max(parts, 1))).alias("p")).agg(F.min("n").alias("n")).orderBy("p").collect()
    return [r["n"] for r in found]


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows, "doc_id", "text", ["text", "sketch"], lambda r: with_sketch(r, F.col("text"), "sketch"))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    text = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                    F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", "n_chars", "sketch", "next_sketch", text.alias("edited"))
    rows = with_sketch(rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)),
                       F.col("edited"), "edited_sketch")
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("sketch")).alias("fingerprint"),
                       as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                       resemblance(F.col("sketch"), F.col("edited_sketch")).cast("double").alias("near_edited"),
                       resemblance(F.col("sketch"), F.col("next_sketch")).cast("double").alias("near_next"))


def op7_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edited(table(spark, sf_dir, "documents"))
