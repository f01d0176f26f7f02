"""The label model against plain loops, and what it makes of voters that repeat each other."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from quire.llm import toxicity as T


def ballots(n=400, seed=1, copies=0):
    """Three independent voters of known accuracy, an abstainer, and copies of the first."""
    rng = random.Random(seed)
    truth = [int(rng.random() < 0.3) for _ in range(n)]
    rows = []
    for y in truth:
        vote = lambda right: (2 * y - 1) * (1 if rng.random() < right else -1)
        first = vote(0.75)
        rows.append([first, vote(0.9), vote(0.7) if rng.random() < 0.6 else 0, *[first] * copies])
    seen = np.array([y if rng.random() < 0.4 else -1 for y in truth])
    return np.array(rows), seen, np.array(truth)


def plain(votes, seen, parents, prior, q):
    """A round of EM with a given tree, cell by cell: the posteriors after guesses ``q``."""
    rows = [[*map(int, r), 0 if s < 0 else 2 * int(s) - 1] for r, s in zip(votes, seen)]
    odds = [math.log(prior / (1 - prior))] * len(rows)
    for j, pa in enumerate(parents):
        def share(y, i):
            """P(vote of row i | class y, parent's vote of row i)."""
            same = [k for k in range(len(rows)) if pa is None or rows[k][pa] == rows[i][pa]]
            weight = lambda k: q[k] if y else 1 - q[k]
            top = sum(weight(k) for k in same if rows[k][j] == rows[i][j]) + 0.5
            return top / (sum(weight(k) for k in same) + 1.5)
        for i in range(len(rows)):
            odds[i] += math.log(share(1, i)) - math.log(share(0, i))
    return [1 / (1 + math.exp(-max(-30, min(30, o)))) for o in odds]


def test_a_round_equals_plain_em():
    for copies in (0, 2):
        votes, seen, _ = ballots(120, copies=copies)
        model = T.LabelModel(votes, seen)
        assert np.allclose(model.q, model.posterior())
        guess = np.random.default_rng(copies).random(120)
        model._estimate(guess)
        assert np.allclose(model.posterior(), plain(votes, seen, model.parents, model.prior, guess), atol=1e-9)


def test_a_vote_that_repeats_another_adds_nothing():
    votes, seen, truth = ballots(3000, copies=0)
    alone = T.LabelModel(votes, seen)
    many = T.LabelModel(*ballots(3000, copies=6)[:2])
    # The copies hang on the first voter, in the tree; independent voters have no parent.
    edges = [{k, p} for k, p in enumerate(many.parents) if p is not None]
    assert sum(e <= {0, 3, 4, 5, 6, 7, 8} for e in edges) == 6 == len(edges)
    assert np.abs(alone.q - many.q).max() < 0.05
    right = ((many.q > 0.5) == truth).mean()
    assert right >= 0.94 and right >= ((alone.q > 0.5) == truth).mean() - 0.01
    assert abs(many.q.mean() - truth.mean()) < 0.05


def test_spanning_tree_takes_the_strongest_edges():
    s = np.zeros((5, 5))
    for a, b, w in [(0, 1, 0.9), (1, 2, 0.8), (0, 2, 0.7), (2, 3, 0.05)]:
        s[a, b] = s[b, a] = w
    parents = T.spanning_tree(s, 0.1)
    edges = {frozenset((k, p)) for k, p in enumerate(parents) if p is not None}
    assert edges == {frozenset((0, 1)), frozenset((1, 2))} and parents.count(None) == 3


def test_entries_are_counted_alike_however_often_a_worker_hands_them_on(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"word{k}" for k in range(60)]
    rows = [(" ".join(rng.sample(words, 8) + (["vile", "nasty"] if k % 3 == 0 else ["fine"])), int(k % 3 == 0)) for k in range(90)] + [(None, 0), ("", 0)]
    df = spark.createDataFrame(rows, "text string, toxic int").repartition(3)
    found = T.induced(df)
    assert {"vile", "nasty", "vile-", "nast-", "nasty-"} & set(found) and "fine" not in found
    counts = {e: [sum(e in {x for w in set((t or "").split()) for x in T.entries_of(w)} for t, y in rows if y == k) for k in (1, 0)] for e in found}
    texts, toxic = len(rows), sum(y for _, y in rows)
    odds = {e: math.log((b + 0.5) / (toxic + 1)) - math.log((g + 0.5) / (texts - toxic + 1)) for e, (b, g) in counts.items()}
    assert all(odds[e] >= T.LEAST_ODDS and counts[e][0] >= T.LEAST_TEXTS for e in found)
    assert found == sorted(found, key=lambda e: (-odds[e] * counts[e][0], e))
    none = T.train(df.select(F.lit(1).alias("key"), "text").limit(0), spark.createDataFrame([(1, 1)], "key int, toxic int"))
    assert none.lexicon == [] and none.score("vile") < 1e-6
