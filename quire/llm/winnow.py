"""Benchmark decontamination by winnowing.

A text's fingerprint is the set of the smallest k-gram hashes of all its windows of
``t = k + w - 1`` words.  Two texts that share t words in a row share the hash chosen in that
window, so joining the fingerprints of documents with those of benchmark items misses no
shared span of t words.  Each joined hit is then extended word by word along its diagonal:
only windows whose words are really equal count.  Items shorter than a window are found the
same way, with a t of the shortest such item.

Defined cases: a null or empty text has no words and is never contaminated; items without
words are ignored; a null item id is written ``null``; repeated items count once an id;
copies of a document are compared once and each row gets the result; an empty table on
either side gives rows without hits.  Only the named columns are read.
Everything is DataFrame operations; texts of whole tables are never shuffled unless more
documents have hits than ``common.sized`` broadcasts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import sized, table, written

WINDOW = 13      # words in a window of an item
GRAM = 5         # words in a gram, at most
SHARE = 20       # contaminated when at least one word in SHARE is hit
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text with only A-Z lower-cased (``lower`` does just that to ASCII texts)."""
    body = F.coalesce(text, F.lit(""))
    low = F.when(F.length(body) == F.octet_length(body), F.lower(body)).otherwise(F.translate(body, UPPER, LOWER))
    return F.filter(F.split(low, NOT_WORD), lambda w: w != "")


def gram_size(t: int) -> int:
    return min(GRAM, (t + 1) // 2)


def with_grams(df: DataFrame, hashes: str, t: int, out: str) -> DataFrame:
    """Add the hashes of all k-grams of an array of word hashes; none if it has under t words."""
    k, h, n = gram_size(t), F.col(hashes), F.size(hashes)
    return df.withColumn(out, F.when(n >= t, F.transform(F.sequence(F.lit(1), n - (k - 1)),
                                                         lambda i: F.xxhash64(F.slice(h, i, k))))
                         .otherwise(F.array().cast("array<long>")))


def chosen(grams: str, t: int) -> Column:
    """The distinct smallest grams of all windows of t words."""
    w = t - gram_size(t) + 1
    g = F.col(grams)
    return F.when(F.size(g) == 0, g).otherwise(F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.size(g) - (w - 1)), lambda i: F.array_min(F.slice(g, i, w)))))


def fingerprints(df: DataFrame, key: str, text: str, spans: list[int]) -> DataFrame:
    """(key, digest, n_words, fingerprint) of every row; it can be kept and joined again."""
    rows = df.select(F.col(key).alias("key"), F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("digest"),
                     F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("hashes"))
    for t in spans:
        rows = with_grams(rows, "hashes", t, f"grams{t}")
    found = F.array_distinct(F.concat(*[chosen(f"grams{t}", t) for t in spans])) if len(spans) > 1 else \
        chosen(f"grams{spans[0]}", spans[0])
    return rows.select("key", "digest", F.size("hashes").cast("long").alias("n_words"), found.alias("fingerprint"))


def item_table(benchmark: DataFrame, item: str, text: str, window: int) -> tuple[DataFrame, list[int]]:
    """Distinct items (no, id, words, span) and the window sizes that they need."""
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("id"),
                             words(F.col(text)).alias("words")).where(F.size("words") > 0).distinct()
    items = written(items.withColumns({"no": F.xxhash64("id", "words"), "span": F.least(F.lit(window), F.size("words"))}),
                    "items")
    shortest = items.where(F.col("span") < window).agg(F.min("span")).first()[0]
    return items, [window] + ([shortest] if shortest else [])


def item_hits(items: DataFrame, spans: list[int], window: int) -> DataFrame:
    """(h, no, t, at): every chosen hash of every item and the places where it stands."""
    parts = []
    for t in spans:
        own = items.where(F.col("span") == window if t == window else F.col("span") < window)
        rows = own.select("no", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
        rows = with_grams(rows, "hashes", t, "grams").select("no", "grams", F.explode(chosen("grams", t)).alias("h"))
        places = F.filter(F.sequence(F.lit(0), F.size("grams") - 1), lambda p: F.get(F.col("grams"), p) == F.col("h"))
        parts.append(rows.select("h", "no", F.lit(t).alias("t"), places.alias("at")))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return written(both, "item_hits")


def extended(pairs: DataFrame, spans: list[int]) -> DataFrame:
    """Exact occurrences for rows (digest, id, span, item, doc, hits): the places in the
    document covered by windows of the item.

    A hit at document place p and item place q lies on the diagonal p - q; the windows along
    the diagonals of all hits are compared word by word."""
    rows = pairs.withColumn("hashes", F.transform("doc", lambda w: F.xxhash64(w)))
    for t in spans:
        rows = with_grams(rows, "hashes", t, f"grams{t}")
    grams = lambda t: F.coalesce(*[F.when(t == s, F.col(f"grams{s}")) for s in spans])
    rows = rows.withColumn("grams", grams(F.col("t")))
    places = lambda h: F.filter(F.sequence(F.lit(0), F.size("grams") - 1),
                                lambda p: F.get(F.col("grams"), p) == h)
    lines = F.flatten(F.transform("hits", lambda x: F.flatten(
        F.transform(places(x["h"]), lambda p: F.transform(x["at"], lambda q: p - q)))))
    rows = rows.select("digest", "id", "span", "item", "doc", F.explode(F.array_distinct(lines)).alias("line"))
    first = F.greatest(F.lit(0), -F.col("line"))
    last = F.least(F.size("item"), F.size("doc") - F.col("line")) - F.col("span")
    rows = rows.withColumns({"first": first, "last": last}).where("last >= first")
    starts = F.filter(F.sequence("first", "last"), lambda j: F.slice("doc", F.col("line") + j + 1, F.col("span"))
                      == F.slice("item", j + 1, F.col("span")))
    rows = rows.select("digest", "id", "span", "line", starts.alias("starts")).where(F.size("starts") > 0)
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda j: F.sequence(
        F.col("line") + j, F.col("line") + j + F.col("span") - 1))))
    return rows.select("digest", "id", covered.alias("covered"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """(key, digest, n_words, n_hit, items): words of every document, words inside occurrences
    of windows of benchmark items, and the sorted ids of those items."""
    items, spans = item_table(benchmark, item, item_text, window)
    own = written(fingerprints(docs, key, text, spans), "fingerprints")
    targets = item_hits(items, spans, window)
    hits = own.select("digest", "key", F.explode("fingerprint").alias("h")).join(sized(targets), "h")
    pairs = written(hits.groupBy("digest", "no", "t").agg(F.collect_set(F.struct("h", "at")).alias("hits"),
                                                          F.min("key").alias("key")), "pairs")
    # The text of one document per distinct content with hits.
    wanted = written(pairs.groupBy("digest").agg(F.min("key").alias("k")).withColumnRenamed("digest", "d"), "wanted")
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    texts = docs.select(F.col(key).alias("key"), digest.alias("digest"), F.col(text).alias("text"))
    texts = texts.join(sized(wanted), F.col("key").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d"))) \
        .select("digest", "text").dropDuplicates(["digest"]).select("digest", words(F.col("text")).alias("doc"))
    met = pairs.drop("key").join(texts, "digest").join(sized(items.select("no", "id", "span", F.col("words").alias("item"))), "no")
    found = extended(met, spans).groupBy("digest").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).cast("long").alias("n_hit"),
        F.sort_array(F.collect_set("id")).alias("items"))
    found = written(found.withColumnRenamed("digest", "d"), "found")
    return own.join(sized(found), F.col("digest") == F.col("d"), "left").select(
        F.col("key").alias(key), "digest", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contaminated(n_hit: Column, n_words: Column, share: int = SHARE) -> Column:
    return (n_hit > 0) & (n_hit * share >= n_words)


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    rows = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                       contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


#: Every window of every document against every window of every item.
OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
s AS (SELECT id, w, CAST(least({WINDOW}, len(w)) AS BIGINT) AS l FROM i WHERE len(w) > 0),
g AS (SELECT DISTINCT id, l, array_to_string(w[j:j + l - 1], ' ') AS gram
      FROM (SELECT id, l, w, unnest(range(1, len(w) - l + 2)) AS j FROM s)),
x AS (SELECT doc_id, l, p, array_to_string(w[p:p + l - 1], ' ') AS gram
      FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p
            FROM d, (SELECT DISTINCT l FROM s) WHERE len(w) >= l)),
h AS (SELECT doc_id, p, l, id FROM x JOIN g USING (l, gram)),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit
      FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, list_sort(list(DISTINCT id)) AS ids FROM h GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit > 0 AND {SHARE} * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
