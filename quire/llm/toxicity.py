"""Toxicity by weak supervision.

From a bounded sample of labelled rows, words and word beginnings that stand out in toxic
texts become lexicons.  Many voters look at a text: one per lexicon part, some for how many
entries it has and how dense they are, some for patterns, and some that vote clean when
nothing is found.  A generative label model estimates by EM how accurate each voter is, given the
vote of the voter that it depends on most: a tree over the strongest correlations within a
class, so that the posteriors account for them.  Its posteriors, not the labels, train a linear
classifier (logistic regression) whose score is a function of the text alone.

Defined cases: null and empty texts are scored as texts without any word; rows without a
key or a label teach nothing; several labels of a key count as toxic if any does; of
several texts of a key the smallest teaches; repeated rows keep a row each; without labelled rows, or with one class only, every score is 0; texts
of any length are read whole.  Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import held_out, table, written

SAMPLE = 40_000       # labelled rows that teach, at most (by a hash of the key)
ENTRIES = 400         # lexicon entries, at most
LEAST_TEXTS = 4       # toxic sample texts that an entry stands in, at least
LEAST_ODDS = 2.5      # log odds of an entry, at least
BEGINNINGS = range(4, 9)
LEXICONS = 12         # parts that the entries are dealt into, each a voter
ROUNDS = 30           # EM rounds, and Newton steps of the classifier
LEAST_VARIANCE = 0.02
TREES = 3             # times that the tree of dependent voters is drawn
LEAST_CORRELATION = 0.1   # within a class, of voters that are modelled as dependent
THRESHOLD = 0.7
KNOWN = 100_000       # words whose entries a worker keeps at most
COUNTED = 100_000     # entries that a worker counts before it hands them on, about

WORD = re.compile(r"[^\W\d_]+")
CAPITAL = re.compile("[A-Z]")
SHOUT = re.compile(r"[!?]{2,}")


def entries_of(word: str) -> list[str]:
    """What a lexicon may hold of a word: the word, and its beginnings (marked by a dash)."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) >= n)]


class Reader:
    """Counts the lexicon entries in a text."""

    def __init__(self, lexicon: list[str]):
        self.at = {e: i for i, e in enumerate(lexicon)}
        self.known: dict[str, tuple[int, ...]] = {}

    def word(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            found = self.known[word] = tuple(self.at[e] for e in entries_of(word) if e in self.at)
        return found

    def read(self, text: str) -> tuple[set[int], np.ndarray]:
        """The entries found, and numbers: words, words with an entry, different such words,
        entries, shouts, and the share of capitals."""
        words = WORD.findall(text.lower())
        hits = [w for w in words if self.word(w)]
        entries = {i for w in set(hits) for i in self.word(w)}
        capitals = len(CAPITAL.findall(text))
        return entries, np.array([len(words), len(hits), len(set(hits)), len(entries),
                                  len(SHOUT.findall(text)), capitals / max(len(text), 1)])


# --- voters -------------------------------------------------------------------------

def votes(entries: set[int], numbers: np.ndarray) -> list[int]:
    """Votes of all voters: 1 toxic, -1 clean, 0 none."""
    words, hits, kinds, n, shouts, capitals = numbers
    parts = {i % LEXICONS for i in entries}
    dense = hits / max(words, 1)
    return [*(1 if k in parts else 0 for k in range(LEXICONS)),
            1 if kinds >= 2 else 0, 1 if kinds >= 4 else 0, 1 if hits >= 3 else 0,
            1 if dense > 0.02 else -1 if dense < 0.002 else 0,
            -1 if not hits else 0, -1 if kinds <= 1 and words >= 20 else 0,
            1 if shouts >= 3 and hits else 0, 1 if capitals > 0.3 and hits else 0,
            -1 if words < 3 and not hits else 0]


class LabelModel:
    """Voter accuracies and dependences, estimated by EM; ``seen`` holds known labels
    (0, 1) or -1 and takes part as one more, imperfect voter.

    Within a class the voters form a tree: the strongest correlations are its edges, where they
    are over ``LEAST_CORRELATION``, and a voter's votes depend on the class and on its parent's vote.  So a
    vote that only repeats another's adds little to a posterior."""

    def __init__(self, ballots: np.ndarray, seen: np.ndarray):
        ballots = np.column_stack([ballots, np.where(seen < 0, 0, 2 * seen - 1)])
        self.cast = np.stack([ballots == v for v in (-1, 0, 1)], 2).astype(float)  # rows, voters, outcomes
        toxic = (ballots == 1).sum(1) - (ballots == -1).sum(1)
        q = np.where(seen >= 0, np.where(seen == 1, 0.95, 0.05), 1 / (1 + np.exp(-toxic)))
        known = seen[seen >= 0]
        self.prior = float(np.clip(known.mean() if len(known) else q.mean(), 1e-3, 1 - 1e-3))
        for _ in range(TREES):     # a tree of the first guesses, then one of better ones
            self.correlations = self._correlations(q, ballots)
            self.parents = spanning_tree(self.correlations, LEAST_CORRELATION)
            for _ in range(ROUNDS):
                self._estimate(q)
                q = self.posterior()
        self.q = q

    @staticmethod
    def _correlations(q: np.ndarray, ballots: np.ndarray) -> np.ndarray:
        """Sizes of the voters' correlations within a class, averaged over the classes."""
        dependence = np.zeros((ballots.shape[1],) * 2)
        for w in (1 - q, q):
            centred = ballots - (w @ ballots) / max(w.sum(), 1e-9)
            cov = (centred * w[:, None]).T @ centred / max(w.sum(), 1e-9)
            sd = np.sqrt(np.maximum(np.diag(cov), LEAST_VARIANCE))  # voters that hardly vary within a class tell little
            dependence += np.abs(cov / np.outer(sd, sd)) * w.sum() / len(q)
        np.fill_diagonal(dependence, 0)
        dependence[-1] = dependence[:, -1] = 0   # the known labels are no reader of the text
        return dependence

    def _estimate(self, q: np.ndarray) -> None:
        """log P(vote | class, parent's vote) of every voter: class, parent's outcome, outcome."""
        self.tables = []
        for voter, parent in enumerate(self.parents):
            own = self.cast[:, voter]
            beside = np.ones((len(own), 1)) if parent is None else self.cast[:, parent]
            counts = np.stack([np.einsum("i,ip,io->po", w, beside, own) for w in (1 - q, q)]) + 0.5
            self.tables.append(np.log(counts / counts.sum(2, keepdims=True)))

    def posterior(self) -> np.ndarray:
        odds = np.full(len(self.cast), np.log(self.prior / (1 - self.prior)))
        for voter, parent in enumerate(self.parents):
            ratio = self.tables[voter][1] - self.tables[voter][0]
            own = self.cast[:, voter]
            odds += own @ ratio[0] if parent is None else np.einsum("ip,po,io->i", self.cast[:, parent], ratio, own)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def spanning_tree(strength: np.ndarray, least: float) -> list[int | None]:
    """The parent of every node in a spanning forest of the strongest edges over ``least``."""
    n = len(strength)
    parents: list[int | None] = [None] * n
    inside: set[int] = set()
    best = {k: (0.0, None) for k in range(n)}
    while len(inside) < n:
        node = max((k for k in range(n) if k not in inside), key=lambda k: (best[k][0], -k))
        inside.add(node)
        parents[node] = best[node][1]
        for k in range(n):
            if k not in inside and strength[node, k] > max(least, best[k][0]):
                best[k] = (strength[node, k], node)
    return parents


# --- the classifier -----------------------------------------------------------------

def features(entries: set[int], numbers: np.ndarray) -> tuple[list[int], list[float]]:
    words, hits, kinds, n, shouts, capitals = numbers
    return sorted(entries), [np.log1p(hits), np.log1p(kinds), np.log1p(n), min(hits / max(words, 1) * 50, 3),
                             float(hits > 0), float(kinds > 1), 1.0]


def fit(rows: np.ndarray, target: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton's method."""
    w, penalty = np.zeros(rows.shape[1]), np.full(rows.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        step = np.linalg.solve((rows * (p * (1 - p) + 1e-6)[:, None]).T @ rows + np.diag(penalty),
                               rows.T @ (target - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    def __init__(self, lexicon: list[str], weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights
        self.reader = Reader(lexicon)

    def __reduce__(self):
        return Model, (self.lexicon, self.weights)

    def score(self, text: str) -> float:
        found, dense = features(*self.reader.read(text))
        n = len(self.lexicon)
        z = self.weights[found].sum() + self.weights[n:] @ dense
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def induced(sample: DataFrame) -> list[str]:
    """The entries that stand out in toxic texts of a sample (text, toxic), strongest first."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}    # of an entry its toxic and other texts

        def flushed() -> pa.RecordBatch:
            return pa.record_batch({"entry": pa.array(counts.keys(), pa.string()),
                                    "bad": pa.array([c[0] for c in counts.values()], pa.int64()),
                                    "good": pa.array([c[1] for c in counts.values()], pa.int64())})

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                at = 0 if toxic.as_py() else 1
                for entry in {e for w in set(WORD.findall((text.as_py() or "").lower())) for e in entries_of(w)}:
                    counts.setdefault(entry, [0, 0])[at] += 1
                if len(counts) >= COUNTED:
                    yield flushed()
                    counts.clear()
        yield flushed()

    texts, toxic = sample.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not texts or not toxic or toxic == texts:
        return []
    counts = sample.select("text", "toxic").mapInArrow(tally, "entry string, bad long, good long") \
        .groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (toxic + 1.0)) - F.log((F.col("good") + 0.5) / (texts - toxic + 1.0))
    strong = counts.withColumn("odds", odds).where((F.col("bad") >= LEAST_TEXTS) & (F.col("odds") >= LEAST_ODDS))
    return [r["entry"] for r in strong.orderBy(F.desc(F.col("odds") * F.col("bad")), "entry").limit(ENTRIES).collect()]


def train(texts: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of rows (key, text) that have a label (key, toxic)."""
    labels = written(labels.where("key IS NOT NULL AND toxic IS NOT NULL").groupBy("key")
                     .agg(F.max("toxic").cast("int").alias("toxic")), "labels")
    share = min(1.0, 0.95 * SAMPLE / max(labels.count(), 1))
    chosen = labels.where(F.xxhash64("key") / F.lit(2.0 ** 64) + 0.5 < share).limit(SAMPLE)
    # One text a key, whatever is repeated: the sample has at most SAMPLE rows.
    sample = written(texts.join(F.broadcast(chosen), "key").groupBy("key")
                     .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).drop("key"), "sample")
    lexicon = induced(sample)
    if not lexicon:
        return Model([], np.array([0.0] * 6 + [-30.0]))
    reader = Reader(lexicon)
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Reader(shared.value)
        for batch in batches:
            found = [own.read(t.as_py() or "") for t in batch["text"]]
            yield pa.record_batch({"entries": pa.array([sorted(e) for e, _ in found], pa.list_(pa.int32())),
                                   "numbers": pa.array([n.tolist() for _, n in found], pa.list_(pa.float64())),
                                   "toxic": batch["toxic"]})

    rows = sample.mapInArrow(read, "entries array<int>, numbers array<double>, toxic int").toArrow().to_pylist()
    found = [(set(r["entries"]), np.array(r["numbers"])) for r in rows]
    label_model = LabelModel(np.array([votes(*f) for f in found]), np.array([r["toxic"] for r in rows]))
    matrix = np.zeros((len(found), len(lexicon) + 7))
    for k, f in enumerate(found):
        at, dense = features(*f)
        matrix[k, at] = 1
        matrix[k, len(lexicon):] = dense
    return Model(lexicon, fit(matrix, label_model.q))


def scores(df: DataFrame, model: Model, text: str = "text") -> Column:
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([shared.value.score(t.as_py() or "") for t in batch], pa.float64())

    return score(F.col(text))


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the documents whose labels may be learned."""
    known = labels.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("key"), "toxic")
    return train(docs.select(F.col("doc_id").alias("key"), "text"), known)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scores(docs, model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
