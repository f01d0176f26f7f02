"""Token counts through a digest cache.

A cache is a Parquet folder of (tokenizer, content, n_tokens), keyed by the digest of the
tokenizer's file and the digest of the normalised content.  ``count_tokens`` joins the
documents' digests to it, encodes one text of every distinct missing content, appends those
counts, and reads every document's count from the cache.

Defined cases: a null text counts as the empty text; texts of any length are tokenised
whole, in blocks cut at safe places; copies are encoded once; rows with null or repeated
keys keep their own output row each; an empty input leaves the cache as it is.  The input's
columns are all kept; an output name that already exists raises.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import LONE_SPACE, file_bytes, safe_blocks, scratch, table, unused, written
from quire.operators.joins import hot_keys, lookup_join

CACHE_SCHEMA = "tokenizer string, content string, n_tokens long"
MAX_TOKENS = 2048
HOT_ROWS = 1_000      # rows of one content from which its join is split off, at least
BATCH_CHARS = 1 << 18   # characters handled at once
KNOWN = 1_000_000       # stretches whose counts a worker keeps at most


def normalised(text: Column) -> Column:
    """What the digest is taken of: null is the empty text; nothing else may change, so that
    equal digests mean equal counts under every tokenizer."""
    return F.coalesce(text, F.lit(""))


class Counter:
    """One tokenizer file and the exact number of tokens it gives for a text.

    Where the file's own splitting never joins what a lone space parts, the library is asked
    once for every distinct stretch between such spaces; otherwise for the whole text."""

    def __init__(self, kind: str, data: bytes):
        self.known: dict[str, int] = {}
        if kind == "json":
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            tokenizer = Tokenizer.from_buffer(data)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.divided = _splits_at_spaces(json.loads(data))
            self.encode = lambda texts: map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False))
        elif kind == "model":
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_proto=data)
            self.divided = False
            self.encode = lambda texts: map(len, pieces.encode(texts, num_threads=1))
        else:
            raise ValueError(f"no library reads .{kind} files")

    def count(self, texts) -> list[int]:
        """Counts of whole texts, a bounded number of characters at a time."""
        counts, parts, size = [], [], 0
        for text in texts:
            counts.append(0)
            for block in safe_blocks(text, BATCH_CHARS) if self.divided else (text,):
                parts.append((len(counts) - 1, block))
                size += len(block)
                if size >= BATCH_CHARS:
                    self._add(parts, counts)
                    parts, size = [], 0
        self._add(parts, counts)
        return counts

    def _add(self, parts: list[tuple[int, str]], counts: list[int]) -> None:
        if not self.divided:
            for (owner, _), n in zip(parts, self.encode([block for _, block in parts])):
                counts[owner] += n
            return
        # Each stretch but a block's first keeps the space before it.
        split = [LONE_SPACE.split(block) for _, block in parts]
        if len(self.known) >= KNOWN:
            self.known.clear()
        new = [s for s in set().union(*split) if s not in self.known]
        self.known.update(zip(new, self.encode([" " + s for s in new])))
        for (owner, _), stretches, n in zip(parts, split, self.encode([s[0] for s in split])):
            counts[owner] += n + sum(map(self.known.__getitem__, stretches[1:]))


def _splits_at_spaces(spec: dict) -> bool:
    """Does this file split texts before every lone space (word and byte-level patterns do)?"""
    steps = [s for s in (spec.get("normalizer"), spec.get("pre_tokenizer")) if s]
    steps = [x for s in steps for x in (s.get("normalizers") or s.get("pretokenizers") or [s])]
    known = {"NFC", "Lowercase", "Replace", "Split", "ByteLevel"}
    return (any(s["type"] == "ByteLevel" for s in steps) and all(s["type"] in known for s in steps)
            and not any(s.get("add_prefix_space") for s in steps)
            and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in spec.get("added_tokens", [])))


@functools.lru_cache(maxsize=2)
def counter(kind: str, data: bytes) -> Counter:
    return Counter(kind, data)


def tokenizer_digest(path: str) -> str:
    return hashlib.sha256(file_bytes(path)).hexdigest()


def read_cache(spark, cache_dir: str, version: str) -> DataFrame:
    """The stored counts of one tokenizer version, one row per content."""
    if not _exists(spark, cache_dir):
        return spark.createDataFrame([], "content string, n_tokens long")
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache_dir).where(F.col("tokenizer") == version)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))  # appends may overlap


def _exists(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def encode_texts(rows: DataFrame, path: str) -> DataFrame:
    """(content, n_tokens) of rows (content, text)."""
    kind, shared = path.rpartition(".")[2], rows.sparkSession.sparkContext.broadcast(file_bytes(path))

    @F.arrow_udf("long")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = counter(kind, shared.value)
        for batch in batches:
            yield pa.array(library.count(v.as_py() or "" for v in batch), pa.int64())

    return rows.select("content", n_tokens("text").alias("n_tokens"))


def content_counts(df: DataFrame, path: str, cache_dir: str, text: str = "text", key: str = "doc_id",
                   out: str = "n_tokens") -> DataFrame:
    """(key, content, n_bytes, tokens): one row per input row, without its text; contents not
    yet in the cache are appended to it.

    Texts are shuffled once, and only those of one row per missing content are encoded;
    everything else moves digests."""
    spark, version = df.sparkSession, tokenizer_digest(path)
    body = normalised(F.col(text))
    digest = F.sha2(body.cast("binary"), 256)
    contents = written(df.select(F.col(key).alias("key"), digest.alias("content"),
                                 F.octet_length(body).cast("long").alias("n_bytes")), "digests")
    # One row a content before anything is joined: a content that many rows share is a count, not a hot key.
    missing = (contents.groupBy("content").agg(F.min("key").alias("key"))
               .join(read_cache(spark, cache_dir, version), "content", "left_anti"))
    missing = written(missing, "missing")
    texts = df.select(F.col(key).alias("key"), digest.alias("content"), body.alias("text"))
    chosen = missing.withColumnsRenamed({"key": "k", "content": "c"})
    found = texts.join(chosen, texts.key.eqNullSafe(F.col("k")) & (texts.content == F.col("c")), "left_semi")
    new = encode_texts(found, path).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    new.select(F.lit(version).alias("tokenizer"), "content", "n_tokens").write.mode("append").parquet(cache_dir)
    counts = read_cache(spark, cache_dir, version).withColumnRenamed("n_tokens", out)
    return lookup_join(contents, counts, "content", "left", min_rows=HOT_ROWS).select(*contents.columns, out)


def count_tokens(df: DataFrame, path: str, cache_dir: str, text: str = "text", key: str = "doc_id",
                 out: str = "n_tokens") -> DataFrame:
    """The input with the token count of every whole text added."""
    if out.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the input already has a column {out}")
    own = unused(df, "content")
    counts = written(content_counts(df, path, cache_dir, text, key, out), "counts").withColumnRenamed("content", own)
    rows = df.withColumn(own, F.sha2(normalised(F.col(text)).cast("binary"), 256))
    # The hot contents are found on digests, not on the texts.
    hot = hot_keys(counts.select(own), own, min_rows=HOT_ROWS)
    return lookup_join(rows, counts.select(own, out).distinct(), own, "left", hot=hot).select(*df.columns, out)


def limits(docs: DataFrame, path: str, cache_dir: str) -> DataFrame:
    """Per document: bytes, tokens, and whether it is over ``MAX_TOKENS``."""
    return content_counts(docs, path, cache_dir).select(
        F.col("key").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"))


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    """A fresh cache each time, so that a repeated run does the whole work again."""
    import public_tokenizers as P

    return limits(table(spark, sf_dir, "documents"), P.path("word_bpe_49k.json"), scratch(spark, "token_cache"))
