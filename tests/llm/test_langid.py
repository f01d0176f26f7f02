"""Kneser-Ney models against plain dictionaries, and the joined path against the arrays."""

import math
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from quire.llm import langid as L


def letters_of(text):
    """The symbols of a text as a list of letters, '' for the boundary."""
    out = [""] * 3
    for c in text:
        s = c.lower()[0] if unicodedata.category(c)[0] == "L" else ""
        if s or out[-1]:
            out.append(s)
    if out[-1] or len(out) == 3:
        out += [""] if out[-1] else []
    return out


class Plain:
    """Interpolated Kneser-Ney of one language, from dictionaries."""

    def __init__(self, texts, alphabet):
        self.alphabet, self.c = alphabet, {4: Counter()}
        for t in texts:
            s = letters_of(t)
            self.c[4].update(tuple(s[k:k + 4]) for k in range(len(s) - 3))
        for n in (3, 2, 1):
            self.c[n] = Counter(g[1:] for g in self.c[n + 1])
        self.d, self.total, self.types = {}, {}, {}
        for n in self.c:
            once, twice = (sum(v == k for v in self.c[n].values()) for k in (1, 2))
            self.d[n] = once / (once + 2 * twice) if once and twice else 0.5
            self.total[n], self.types[n] = defaultdict(int), defaultdict(int)
            for g, v in self.c[n].items():
                self.total[n][g[:-1]] += v
                self.types[n][g[:-1]] += 1

    def p(self, g):
        n = len(g)
        if n == 0:
            return 1 / (self.alphabet + 2)
        total = self.total[n].get(g[:-1], 0)
        if not total:
            return self.p(g[1:])
        kept = max(self.c[n].get(g, 0) - self.d[n], 0) / total
        return kept + self.d[n] * self.types[n][g[:-1]] / total * self.p(g[1:])

    def entropy(self, text):
        s = letters_of(text)
        gs = [tuple(s[k:k + 4]) for k in range(len(s) - 3)]
        return -sum(math.log2(self.p(g)) for g in gs) / len(gs)


TEXTS = {"de": ["schöne Straße über Köln", "größe und möglich", "ähnlich, über alles"], "es": ["mañana será otro día", "niño pequeño año"],
         "fr": ["été où l'élève à l'école", "ça où très"], "ru": ["привет как дела", "хорошо Москва"], "el": ["καλημέρα κόσμε"], "zh": ["你好世界", "世界人民"]}


def sample(spark, most=None):
    rows = [(lang, t) for lang, ts in TEXTS.items() for t in ts]
    return spark.createDataFrame(rows, "lang string, text string")


def test_probabilities_equal_plain_kneser_ney(spark):
    counts, letters = L.counted(sample(spark).repartition(3))
    model = L.model_of(counts, letters)
    known = {c.lower() for ts in TEXTS.values() for t in ts for c in t if unicodedata.category(c)[0] == "L"}
    assert set(map(chr, letters)) == known and len(letters) == len(known)
    plain = {lang: Plain(ts, len(known)) for lang, ts in TEXTS.items()}
    tries = [t for ts in TEXTS.values() for t in ts] + ["schon strasse", "ñandú", "ωmega Ω", "日本", "naïve Þing", "x" * 50, "a  --  b", "Привет, мир"]
    for t in tries:
        got = dict(zip(model.langs, model.entropies(t)))
        for lang, m in plain.items():
            assert math.isclose(got[lang], m.entropy(t), rel_tol=1e-5), (t, lang)
    # Letters that differ only by their marks are told apart, and probabilities of what may follow add up to one.
    assert model.lut[ord("ä")] != model.lut[ord("ñ")] != model.lut[ord("n")]
    every = [*sorted(known), "", "ᚠ"]
    for context in [("", "", ""), ("s", "c", "h"), ("", "ü", "b"), ("q", "q", "q")]:
        assert math.isclose(sum(plain["de"].p((*context, x)) for x in every), 1, rel_tol=1e-9)


def test_joined_entropies_equal_the_arrays(spark):
    counts, letters = L.counted(sample(spark))
    model = L.model_of(counts, letters)
    assert L.model_of(counts, letters, most=3) is None
    tries = [*(t for ts in TEXTS.values() for t in ts), "schon strasse", "ωmega", "日本", "plain words", "a", "12", "", None, "ab " * 3000]
    rows = spark.createDataFrame(list(enumerate(tries)), "id int, text string")
    got = {r.id: r for r in L.joined_entropies(rows, counts, letters).collect()}
    for k, t in enumerate(tries):
        want = model.entropies(t or "")
        if want is None:
            assert k not in got
            continue
        order = np.argsort(want)
        assert got[k].lang == model.langs[order[0]] and math.isclose(got[k].entropy, want[order[0]], rel_tol=1e-5)
        assert math.isclose(got[k].margin, want[order[1]] - want[order[0]], rel_tol=1e-3, abs_tol=1e-5)


def test_both_paths_identify_alike_and_short_texts_by_their_letters(spark):
    rng = random.Random(2)
    rows = []
    for lang, ts in TEXTS.items():
        words = " ".join(ts).split()
        rows += [(lang, " ".join(rng.choice(words) for _ in range(8))) for _ in range(40)]
    data = [(k, t, lang) for k, (lang, t) in enumerate(rows)] + [(9000, None, "de"), (9001, "12 !", "de"), (None, "über", None), (0, rows[0][1], "de")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(4)
    learn = F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False))
    one = L.identify(df, learn).collect()
    two = L.identify(df, learn, most=10).collect()
    key = lambda r: (str(r.doc_id), r.lang_pred, round(r.score, 6), r.rejected)
    assert sorted(map(key, one)) == sorted(map(key, two)) and len(one) == len(data)
    want = {d[0]: d[2] for d in data}
    judged = [r for r in one if r.doc_id is not None and r.doc_id < 9000]
    assert sum(r.lang_pred == want[r.doc_id] for r in judged) >= 0.98 * len(judged)
    assert {(r.lang_pred, r.score) for r in one if r.doc_id in (9000, 9001)} == {("und", 0.0)}
