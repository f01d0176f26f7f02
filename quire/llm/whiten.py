"""Whitening of embeddings from polarised variances.

Entries become integers (``floor(scale * entry)``).  Over the distinct integer vectors, n of them with
sums S, every dimension and every sum of two dimensions is centred exactly (n * x - S) and the
squares of these integers are added up exactly.  A covariance is never formed from
products of two dimensions: ``(Var(a + b) - Var(a) - Var(b)) / 2`` recovers it, in integers, and only the
finished entries are rounded.  ``eigh`` of that matrix gives the components.

Exact sums: tasks split centred values into limbs of ``LIMB`` bits, so that products of limbs
add up in 64-bit integers; Spark adds the tasks' sums as decimals, and the driver puts limbs
together in integers of any length.  What reaches the driver is one row for each dimension or pair and
pair of limbs, whatever the number of rows.

Defined cases: rows whose vector is null or holds a null or non-finite entry are dropped;
shorter vectors are filled with zeros up to the longest one (an empty vector is all zeros); entries
beyond a 64-bit integer become its ends; equal vectors count once in the fit, but every row gets its
result, also rows with a null or repeated key; a component without variance (at most ``NONE`` of the
largest eigenvalue) has a null ``whitened`` and does not count in ``identity_error``; without
rows, or of dimension 0, there are no results.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import importable, table, written

SCALE = 256
LIMB = 21
BLOCK = 1024          # rows centred and squared at once
NONE = 1e-13
COMPONENTS = 4
COLUMNS = {"component": "int", "n": "long", "deviation": "decimal(38,0)", "whitened": "double",
           "explained": "double", "identity_error": "double"}


def usable(vector: Column) -> Column:
    def bad(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, bad), F.lit(False))


def integers(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(len(column), 1))


def _blocks(batch: pa.RecordBatch, name: str = "x") -> Iterator[np.ndarray]:
    for at in range(0, batch.num_rows, BLOCK):
        yield _matrix(batch[name].slice(at, BLOCK))


@dataclass
class Totals:
    n: int
    sums: list[int]
    least: list[int]
    most: list[int]


def totals(fit: DataFrame) -> Totals | None:
    """n, and per dimension the exact sum, least and greatest value."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            for x in _blocks(batch):
                own = [np.full(x.shape[1], len(x)), (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0), x.min(0), x.max(0)]
                found = own if found is None else [found[0] + own[0], found[1] + own[1], found[2] + own[2],
                                                   np.minimum(found[3], own[3]), np.maximum(found[4], own[4])]
        if found is not None:
            yield pa.record_batch({"i": pa.array(np.arange(len(found[0]))), **{c: pa.array(v) for c, v in
                                                                              zip(("n", "high", "low", "least", "most"), found)}})

    parts = fit.mapInArrow(add, "i long, n long, high long, low long, least long, most long")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")],
                                  F.min("least").alias("least"), F.max("most").alias("most")).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: r["i"])
    return Totals(rows[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in rows],
                  [r["least"] for r in rows], [r["most"] for r in rows])


def centred(x: np.ndarray, t: Totals) -> np.ndarray:
    """n * x - S, exactly: 64-bit integers where they hold every sum of two, else Python's."""
    if _bits(t) < 62:
        return x * np.int64(t.n) - np.array(t.sums, np.int64)
    return x.astype(object) * t.n - np.array(t.sums, object)


def _bits(t: Totals) -> int:
    """Bits that hold n * x, and n * x - S of two dimensions added."""
    return max([0, *(max(abs(t.n * a), abs(t.n * b), abs(s), 2 * abs(t.n * a - s), 2 * abs(t.n * b - s)).bit_length()
                     for a, b, s in zip(t.least, t.most, t.sums))]) + 1


def _limbs(c: np.ndarray, count: int, bits: int) -> list[np.ndarray]:
    """Signed integers as limbs, the lowest first; the last one carries the sign."""
    mask = (1 << bits) - 1
    parts = [(c >> bits * k) & mask for k in range(count - 1)] + [c >> bits * (count - 1)]
    return [p.astype(np.int64) for p in parts]


def squares(fit: DataFrame, t: Totals, limb: int = LIMB) -> dict[tuple[int, int], int]:
    """The exact sum of squares of every centred dimension (i, i) and sum of two (i, j)."""
    shared, count = t, -(-_bits(t) // limb)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(shared.sums)
        found = {(p, q): np.zeros((d, d), np.int64) for p in range(count) for q in range(p, count)}
        some = False
        for batch in batches:
            for x in _blocks(batch):
                some, c = True, centred(x, shared)
                for i in range(d):
                    pair = c[:, i:] + c[:, i:i + 1]
                    pair[:, 0] = c[:, i]      # the dimension itself, not twice itself
                    limbs = _limbs(pair, count, limb)
                    for (p, q), into in found.items():
                        into[i, i:] += np.einsum("ij,ij->j", limbs[p], limbs[q])
        if some:
            i, j = np.triu_indices(d)
            for (p, q), total in found.items():
                yield pa.record_batch({"i": pa.array(i), "j": pa.array(j), "p": pa.array(np.full(len(i), p)),
                                       "q": pa.array(np.full(len(i), q)), "s": pa.array(total[i, j])})

    parts = fit.mapInArrow(add, "i long, j long, p long, q long, s long")
    parts = parts.groupBy("i", "j", "p", "q").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
    found: dict[tuple[int, int], int] = {}
    for r in parts.toLocalIterator():   # one row a dimension pair and limb pair
        times = 1 if r["p"] == r["q"] else 2
        found[r["i"], r["j"]] = found.get((r["i"], r["j"]), 0) + (times * int(r["s"]) << limb * (r["p"] + r["q"]))
    return found


def covariance(q: dict[tuple[int, int], int], n: int, d: int) -> np.ndarray:
    """From exact squares of n * x - S; every entry is rounded once."""
    v = np.empty((d, d))
    for i in range(d):
        v[i, i] = q[i, i] / n ** 3
        for j in range(i + 1, d):
            v[i, j] = v[j, i] = (q[i, j] - q[i, i] - q[j, j]) / (2 * n ** 3)
    return v


@dataclass
class Whitening:
    totals: Totals
    values: np.ndarray       # eigenvalues, falling
    vectors: np.ndarray      # their unit vectors, as columns; the entry of largest size is positive
    trace: float
    scales: np.ndarray       # 1 / sqrt(value), nan where a component has no variance

    def whitened(self, x: np.ndarray) -> np.ndarray:
        centre = centred(x, self.totals).astype(np.float64) / self.totals.n
        return centre @ self.vectors * self.scales


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    t = totals(fit)
    if t is None or not t.sums:
        return None
    v = covariance(squares(fit, t), t.n, len(t.sums))
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(len(order))] < 0, -1.0, 1.0)
    real = values > max(NONE * values[0], 0.0)
    scales = np.where(real, 1 / np.sqrt(np.where(real, values, 1.0)), np.nan)
    return Whitening(t, values, vectors, float(np.trace(v)), scales)


def identity_error(fit: DataFrame, w: Whitening) -> float | None:
    """The largest entry, in size, of the whitened rows' covariance less the identity, measured on all of them."""
    shared = w

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = shared.vectors.shape[1]
        first, second, some = np.zeros(k), np.zeros((k, k)), False
        for batch in batches:
            for x in _blocks(batch):
                z, some = np.nan_to_num(shared.whitened(x)), True
                first += z.sum(0)
                second += z.T @ z
        if some:
            i, j = np.triu_indices(k)
            yield pa.record_batch({"i": pa.array(i), "j": pa.array(j), "s": pa.array(second[i, j]), "f": pa.array(first[i])})

    sums = fit.mapInArrow(add, "i long, j long, s double, f double").groupBy("i", "j").agg(
        F.sum("s").alias("s"), F.sum("f").alias("f")).collect()
    n, real = w.totals.n, ~np.isnan(w.scales)
    mean = {r["i"]: r["f"] / n for r in sums}
    errors = [abs(r["s"] / n - mean[r["i"]] * mean[r["j"]] - (r["i"] == r["j"]))
              for r in sums if real[r["i"]] and real[r["j"]]]
    return max(errors, default=None)


def fit_list(vectors: DataFrame, x: str = "x") -> DataFrame:
    """Every distinct integer vector once."""
    return written(vectors.select(F.col(x).alias("x")).distinct(), "fit")


def whiten(df: DataFrame, key: str, vector: str, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error), ``deviation`` a decimal."""
    importable(df.sparkSession)
    rows = df.select(F.col(key).alias("key"), F.col(vector).alias("v")).where(usable(F.col("v")))
    rows = rows.select("key", integers(F.col("v"), scale).alias("x"))
    longest, shortest = rows.agg(F.max(F.size("x")), F.min(F.size("x"))).first()
    if longest != shortest:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(longest) - F.size("x"))))
    key_type = rows.schema["key"].dataType
    fit = fit_list(rows)
    w = fit_whitening(fit, components)
    if w is None:
        return rows.where("false").select(F.col("key").alias(key), *[F.lit(None).cast(t).alias(c) for c, t in COLUMNS.items()])
    error = identity_error(fit, w)
    shared, k = df.sparkSession.sparkContext.broadcast(w), w.vectors.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _matrix(part["x"])
                z = own.whitened(x)
                c = centred(x, own.totals)
                if c.dtype == object or len(own.totals.sums) * (1 << 2 * _bits(own.totals)) >= 1 << 63:
                    c = c.astype(object)
                deviation = [str(v) for v in (c * c).sum(1)]
                yield pa.record_batch({"key": part["key"], "deviation": pa.array(deviation),
                                       "z": pa.array([[None if np.isnan(v) else float(v) for v in row] for row in z],
                                                     pa.list_(pa.float64()))})

    done = rows.mapInArrow(project, f"key {key_type.simpleString()}, deviation string, z array<double>")
    done = done.select("key", "deviation", F.posexplode("z").alias("at", "whitened"))
    shares = [F.lit(float(e / w.trace) if w.trace > 0 else None).cast("double") for e in w.values]
    explained = F.element_at(F.array(*shares), F.col("at") + 1)
    return done.select(F.col("key").alias(key), (F.col("at") + 1).alias("component"), F.lit(w.totals.n).cast("long").alias("n"),
                       F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened", explained.alias("explained"),
                       F.lit(error).cast("double").alias("identity_error"))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    rows = whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    # An exact result beyond a long is an error (ANSI), never a wrapped number.
    return rows.withColumn("deviation", F.col("deviation").cast("long"))
