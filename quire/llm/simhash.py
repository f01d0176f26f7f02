"""SimHash near-duplicates through a Gray-order hierarchical index.

Distinct fingerprints are sorted by Gray rank and cut into blocks, so neighbours share
most bits.  Every node of the index (a block, a run inside a block, a single fingerprint)
stores the bits that all its members share; two nodes whose shared bits already differ in
more than the allowed number of places are dropped with everything below them.  Blocks are
compared with blocks as Spark groups; each group keeps a spanning forest of the links it
finds, never all pairs, and components are found by contracting that forest.

Defined cases: null, empty and blank texts have fingerprint zero and link like any other;
a text of fewer words than a shingle is one shingle; equal fingerprints always link; null
keys take part but are never the smallest key, and a component without any key has none;
repeated rows keep a row each; an empty input gives an empty result.  Only the key and the
text are read, so extra columns of any name do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import sized, table, written
from quire.operators.joins import lookup_join

SEED = 42
MAX_BITS = 4         # largest number of differing bits that links
WORDS = 4            # words in a shingle
#: Fingerprints in a block, about: small blocks while there are few, up to the most that a task should hold two of.
SMALL_BLOCK, LARGE_BLOCK = 16_384, 1 << 20
LEAST_BLOCKS, FEW_BLOCKS = 8, 64
NODES = 32           # blocks, or nodes, under a node of the index over blocks
HOT_ROWS = 100_000   # rows of one fingerprint or class from which its join is split off
SAMPLE_PER_BLOCK = 64
FANOUT = 4           # children of an index node
STEP = 1 << 16       # node pairs expanded at once


# --- fingerprints -----------------------------------------------------------------

def fingerprint(text: str, words: int = WORDS) -> int:
    """The 64 majority bits of the XXH64 of all word shingles, as a signed integer."""
    import xxhash

    found = text.encode("utf-8", "surrogatepass").lower().split()  # both only touch ASCII
    if not found:
        return 0
    ends = list(accumulate(len(w) + 1 for w in found))
    joined = b" ".join(found)
    starts = [0, *ends]
    digest = xxhash.xxh64_digest
    votes, n = np.zeros(64, np.int64), 0
    for at in range(0, max(len(found) - words + 1, 1), STEP):
        hashes = [digest(joined[s:e - 1], SEED)
                  for s, e in zip(starts[at:at + STEP], ends[words - 1 + at:words - 1 + at + STEP] or ends[-1:])]
        bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 8), axis=1)
        whole = len(bits) // 255 * 255
        votes += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        votes += bits[whole:].sum(axis=0, dtype=np.uint8)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, text: str = "text", words: int = WORDS) -> Column:
    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(v.as_py() or "", words) for v in batch], pa.int64())

    return of(F.col(text))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def gray_rank(fp: Column) -> Column:
    """Place of a bit pattern in Gray order, shifted so that signed order is the order."""
    rank = fp
    for step in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, step))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


# --- the index inside a task ------------------------------------------------------

def _levels(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bits shared, pattern) of every node, leaves first; a node has FANOUT children."""
    every, some = fps, fps
    levels = [(np.full(len(fps), ~np.uint64(0)), fps)]
    while len(every) > FANOUT:
        at = np.arange(0, len(every), FANOUT)
        every, some = np.bitwise_and.reduceat(every, at), np.bitwise_or.reduceat(some, at)
        shared = ~(every ^ some)
        levels.append((shared, every & shared))
    return levels


def _near(a: list, b: list, same: bool, bits: int):
    """Index pairs of near fingerprints, some at a time; nodes are met top down."""
    top = max(len(a), len(b)) - 1
    level = lambda tree, at: tree[min(at, len(tree) - 1)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(level(a, top)[0])), np.arange(len(level(b, top)[0]))))
    stack = [(top, i, j, True)]
    child = np.arange(FANOUT)
    while stack:
        at, i, j, fresh = stack.pop()
        if len(i) > STEP:
            stack += [(at, i[k:k + STEP], j[k:k + STEP], fresh) for k in range(0, len(i), STEP)]
            continue
        if fresh:
            (ma, pa_), (mb, pb) = level(a, at), level(b, at)
            keep = np.bitwise_count((pa_[i] ^ pb[j]) & ma[i] & mb[j]) <= bits
            if same:
                keep &= (i < j) if at == 0 else (i <= j)
            i, j = i[keep], j[keep]
        if not len(i):
            continue
        if at == 0:
            yield i, j
            continue
        down_a, down_b = at < len(a), at < len(b)  # a shallow tree waits at its top
        ci = (i[:, None] * FANOUT + child if down_a else i[:, None])
        cj = (j[:, None] * FANOUT + child if down_b else j[:, None])
        ci, cj = np.broadcast_arrays(ci[:, :, None], cj[:, None, :])
        ci, cj = ci.ravel(), cj.ravel()
        ok = (ci < len(level(a, at - 1)[0])) & (cj < len(level(b, at - 1)[0]))
        stack.append((at - 1, ci[ok], cj[ok], True))


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Merge the classes of i and j; a class is named by its smallest member."""
    while True:
        a, b = label[i], label[j]
        new = a != b
        if not new.any():
            return label
        i, j, a, b = i[new], j[new], a[new], b[new]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, up := label[label]):
            label = up


def forest(a: np.ndarray, b: np.ndarray | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is near within ``a`` (or between ``a`` and ``b``), as a forest."""
    both = a if b is None else np.concatenate([a, b])
    label = np.arange(len(both))
    tree_a = _levels(a)
    tree_b = tree_a if b is None else _levels(b)
    for i, j in _near(tree_a, tree_b, b is None, bits):
        label = _join(label, i, j if b is None else j + len(a))
    child = np.flatnonzero(label != np.arange(len(both)))
    return both[child], both[label[child]]


# --- the join and the components --------------------------------------------------

def links(distinct: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(u, v): links between distinct fingerprints (column ``fp``) that connect exactly what
    chains of links of at most ``bits`` differing bits connect."""
    spark = distinct.sparkSession
    ranked = distinct.select("fp", gray_rank(F.col("fp")).alias("rank"))
    n = ranked.count()
    blocks = max(LEAST_BLOCKS, min(-(-n // SMALL_BLOCK), FEW_BLOCKS), -(-n // LARGE_BLOCK))
    # A sample by hash: the same on every run, and bounded whatever the input.
    every = max(1, n // (blocks * SAMPLE_PER_BLOCK))
    sample = np.sort(np.array([r[0] for r in ranked.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0)
                               .select("rank").limit(4 * blocks * SAMPLE_PER_BLOCK).collect()], np.int64))
    bounds = np.unique(sample[(np.arange(1, blocks) * len(sample)) // blocks]) if len(sample) else sample

    @F.arrow_udf("int")
    def block_of(ranks: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, ranks.to_numpy(zero_copy_only=False), side="right"), pa.int32())

    placed = written(ranked.select("fp", "rank", block_of("rank").alias("block")), "blocks")
    meets = near_blocks(placed, blocks, bits)
    both = F.explode(F.when(F.col("x") == F.col("y"), F.array(F.struct(F.col("x").alias("block"), F.lit(False).alias("second"))))
                     .otherwise(F.array(F.struct(F.col("x").alias("block"), F.lit(False).alias("second")),
                                        F.struct(F.col("y").alias("block"), F.lit(True).alias("second")))))
    meets = meets.select("x", "y", both.alias("m")).select("x", "y", "m.block", "m.second")

    def compare(rows: pa.Table) -> pa.Table:
        fps = rows["fp"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(rows["rank"].to_numpy(), kind="stable")
        second = rows["second"].to_numpy(zero_copy_only=False).astype(bool)[order]
        fps = fps[order]
        alone = rows["x"][0].as_py() == rows["y"][0].as_py()
        u, v = forest(fps, None, bits) if alone else forest(fps[~second], fps[second], bits)
        return pa.table({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

    met = placed.join(sized(written(meets, "meets"), most=1_000_000), "block")
    return met.groupBy("x", "y").applyInArrow(compare, "u long, v long")


def near_blocks(placed: DataFrame, blocks: int, bits: int) -> DataFrame:
    """(x, y), x <= y: the blocks that may hold near fingerprints.  Above the blocks stands a tree whose nodes
    keep the bits that all fingerprints under them share; it is descended level by level, and a
    pair of nodes goes on if their shared bits differ little enough."""
    every, some = F.col("every"), F.col("some")
    level = written(placed.groupBy(F.col("block").cast("long").alias("node")).agg(
        F.expr("bit_and(fp)").alias("every"), F.expr("bit_or(fp)").alias("some")), "nodes")
    levels = [level]
    while (blocks := -(-blocks // NODES)) >= 1:
        level = written(levels[-1].groupBy(F.floor(F.col("node") / NODES).alias("node")).agg(
            F.expr("bit_and(every)").alias("every"), F.expr("bit_or(some)").alias("some")), "nodes")
        levels.append(level)
        if blocks == 1:
            break
    pairs = levels[-1].select(F.col("node").alias("x"), F.col("node").alias("y"))
    shared = F.bitwise_not(every.bitwiseXOR(some))
    for level in reversed(levels[:-1]):
        side = lambda c: level.select(F.floor(F.col("node") / NODES).alias(c), F.col("node").alias("n" + c),
                                      every.alias("e" + c), shared.alias("s" + c))
        differ = F.col("ex").bitwiseXOR(F.col("ey")).bitwiseAND(F.col("sx")).bitwiseAND(F.col("sy"))
        pairs = pairs.join(side("x"), "x").join(side("y"), "y").where((F.col("nx") <= F.col("ny")) & (F.bit_count(differ) <= bits))
        pairs = written(pairs.select(F.col("nx").alias("x"), F.col("ny").alias("y")), "pairs")
    return pairs


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge list (u, v); the root is the smallest node.

    Each round renames every node to its smallest neighbour (or itself), which keeps
    connectivity, and drops edges that became loops; the renamings are then composed."""
    edges = written(edges.where("u <> v").distinct(), "edges")
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node"))
    names = written(nodes, "nodes")
    many = names.count() > HOT_ROWS      # fewer nodes cannot make a hot class
    while not edges.isEmpty():
        both = edges.select("u", "v").union(edges.select("v", "u"))
        step = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("to")), "renames")
        names = written(lookup_join(names, step.withColumnRenamed("u", "root"), "root", "left", min_rows=HOT_ROWS,
                                    hot=None if many else [])
                        .select("node", F.coalesce("to", "root").alias("root")), "nodes")
        ends = edges.join(step, "u").select(F.col("to").alias("a"), "v") \
            .join(step.select(F.col("u").alias("v"), F.col("to").alias("b")), "v")
        edges = written(ends.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
                        .distinct(), "edges")
    return names


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                    bits: int = MAX_BITS) -> DataFrame:
    """(key, fp, component, smallest): one row per input row; ``component`` names the group
    (its smallest fingerprint) and ``smallest`` is the group's smallest key."""
    rows = written(df.select(F.col(key).alias("key"), fingerprints(df, text, words).alias("fp")), "simhash")
    distinct = written(rows.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    names = components(links(distinct, bits))
    group = written(distinct.join(names, distinct.fp == names.node, "left")
                    .select("fp", "least", F.coalesce("root", "fp").alias("component")), "groups")
    least = group.groupBy("component").agg(F.min("least").alias("smallest"))
    group = lookup_join(group.select("fp", "component"), least, "component", min_rows=HOT_ROWS)
    return lookup_join(rows, written(group, "classes"), "fp", min_rows=HOT_ROWS).select(F.col("key").alias(key), "fp", "component", "smallest")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), F.col("smallest").alias("component_id"))
