"""Language identification with interpolated Kneser-Ney character models.

Texts become sequences of symbols: a boundary for every run of non-letters, and the
lower-cased letters themselves.  Spark counts all four-grams of all training texts per
language; from these counts come the continuation counts of the lower orders, the discounts
and the interpolated probabilities.  Each order is stored as one sorted array of packed n-grams
with a column of log probabilities per language, and one sorted array of contexts with their
back-off weights.

Models of at most ``MOST_GRAMS`` four-grams are broadcast (a bounded size, checked before); beyond
that the same probabilities are tables, and Spark joins the distinct four-grams of all texts to
them, order by order (``joined_entropies``).

A text gets the language of the lowest cross-entropy per symbol.  The margin to the second
best is calibrated to a probability of being right (isotonic, from counts over all learning
rows of a fold, by a hash of the text, that the models did not see); a text whose cross-entropy is
far above that language's own is marked rejected.

Defined cases: a null text or one without letters is ``und`` with score 0 and rejected;
without any training row everything is; rows with a null language or text teach nothing;
repeated rows count each time; texts of any length are read whole, in blocks; letters that no
training text has share one symbol (as would, of more than 65,534 different letters, the rarest).  Only
the named columns are read.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import held_out, table, written
from quire.operators.joins import lookup_join

ORDER = 4
BITS = 16            # of a symbol; four make a key
UNSEEN = (1 << BITS) - 1
BLOCK = 1 << 20      # characters handled at once
MOST_GRAMS = 4_000_000  # four-grams of all languages that are broadcast, at most (about 100 MB of arrays)
FOLDS = 8            # one of so many parts of the learning rows calibrates
BINS, BIN = 64, 0.05  # margins (bits a symbol) are calibrated in bins
REJECT_SIGMAS = 4.0


@functools.cache
def lowered() -> np.ndarray:
    """The lower-case letter of every code point that is a letter, else 0."""
    found = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            found[c] = ord(chr(c).lower()[0])
    return found


def symbols(letters: tuple[int, ...]) -> np.ndarray:
    """The symbol of every code point: 0 is the boundary, the known letters are numbered."""
    number = np.full(0x110000, UNSEEN, np.uint16)
    number[list(letters)] = np.arange(1, len(letters) + 1)
    low = lowered()
    return np.where(low > 0, number[low], 0).astype(np.uint16)


def alphabet(texts: DataFrame) -> tuple[int, ...]:
    """The letters of all texts (column ``text``), the most frequent first: at most as many as Unicode has."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            for text in batch["text"]:
                t = text.as_py()
                for at in range(0, len(t), BLOCK):
                    low = lowered()[np.frombuffer(t[at:at + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)]
                    found, n = np.unique(low, return_counts=True)
                    total[found] += n
        letters = np.flatnonzero(total[1:]) + 1
        yield pa.record_batch({"letter": pa.array(letters.astype(np.int32)), "n": pa.array(total[letters])})

    rows = texts.select("text").mapInArrow(count, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    return tuple(r["letter"] for r in rows.orderBy(F.desc("n"), "letter").limit(UNSEEN - 1).collect())


def grams(text: str, lut: np.ndarray) -> Iterator[np.ndarray]:
    """Packed four-grams of a text, which starts after three boundaries and ends with one."""
    carry = np.zeros(ORDER - 1, np.uint64)
    for at in range(0, len(text), BLOCK):
        codes = np.frombuffer(text[at:at + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
        own = lut[codes].astype(np.uint64)
        if at + BLOCK >= len(text):
            own = np.append(own, np.uint64(0))
        own = np.concatenate([carry, own])
        keep = np.ones(len(own), bool)
        keep[ORDER - 1:] = (own[ORDER - 1:] != 0) | (own[ORDER - 2:-1] != 0)
        own = own[keep]
        if len(own) >= ORDER:
            yield own[:-3] << np.uint64(48) | own[1:-2] << np.uint64(32) | own[2:-1] << np.uint64(16) | own[3:]
        carry = own[-(ORDER - 1):]


def count_grams(rows: DataFrame, letters: tuple[int, ...]) -> DataFrame:
    """(lang, gram, n) over all rows (lang, text); tasks add up their own rows first."""
    shared = rows.sparkSession.sparkContext.broadcast(letters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list] = {}
        lut = symbols(shared.value)

        def fold(parts: list) -> list:
            keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return [(keys, np.bincount(at, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64))]

        def rows_of(lang: str, part: tuple) -> pa.RecordBatch:
            return pa.record_batch({"lang": pa.array([lang] * len(part[0])), "gram": pa.array(part[0].view(np.int64)),
                                    "n": pa.array(part[1])})

        for batch in batches:
            found: dict[str, list] = {}
            for lang, text in zip(batch["lang"], batch["text"]):
                found.setdefault(lang.as_py(), []).extend(grams(text.as_py(), lut))
            for lang, arrays in found.items():
                if arrays:
                    kept.setdefault(lang, []).append(np.unique(np.concatenate(arrays), return_counts=True))
                    if len(kept[lang]) >= 16:
                        kept[lang] = fold(kept[lang])
                    if len(kept[lang][0][0]) > 1 << 20:     # a task keeps a bounded part
                        yield rows_of(lang, fold(kept.pop(lang))[0])
        for lang, parts in kept.items():
            yield rows_of(lang, fold(parts)[0])

    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a sorted array, and which of them hold what is wanted."""
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


def _suffix(keys: np.ndarray, n: int) -> np.ndarray:
    """The last n - 1 symbols of n-grams."""
    return keys & np.uint64((1 << BITS * (n - 1)) - 1)


def discount(once: float, twice: float) -> float:
    return once / (once + 2 * twice) if once and twice else 0.5


class Model:
    """Sorted arrays of n-grams and contexts, with a column per language."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], letters: tuple[int, ...]):
        self.langs, self.letters, self.lut = sorted(counts), letters, None
        if not counts:
            return
        own = [self._orders(*counts[lang], len(letters) + 2) for lang in self.langs]
        self.unseen = np.log2([o["unseen"] for o in own])          # order 1, a symbol that a language does not have
        self.keys, self.logs, self.contexts, self.backoffs = {}, {}, {}, {}
        for n in range(1, ORDER + 1):
            if n > 1:
                contexts = functools.reduce(np.union1d, [o[n]["contexts"] for o in own])
                back = np.zeros((len(contexts), len(own)))             # an unseen context passes all on
                for k, o in enumerate(own):
                    back[_lookup(contexts, o[n]["contexts"])[0], k] = np.log2(o[n]["backoff"])
                self.contexts[n], self.backoffs[n] = contexts, back
            keys = functools.reduce(np.union1d, [o[n]["keys"] for o in own])
            logs = self._below(n, keys)
            for k, o in enumerate(own):
                at = _lookup(keys, o[n]["keys"])[0]
                if n == 1:
                    logs[at, k] = np.log2(o[1]["kept"] + o["unseen"])
                    continue
                below = 2.0 ** self._order(n - 1, _suffix(o[n]["keys"], n))[:, k]
                ctx = _lookup(o[n]["contexts"], o[n]["keys"] >> np.uint64(BITS))[0]
                logs[at, k] = np.log2(o[n]["kept"] + o[n]["backoff"][ctx] * below)
            self.keys[n], self.logs[n] = keys, logs.astype(np.float32)

    @staticmethod
    def _orders(keys: np.ndarray, counts: np.ndarray, alphabet: int) -> dict:
        """Discounted relative counts and back-off weights of one language, by order; orders
        below the highest count in how many distinct symbols' company an n-gram is seen."""
        found = {}
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        for n in range(ORDER, 0, -1):
            d = discount((counts == 1).sum(), (counts == 2).sum())
            if n == 1:
                found["unseen"] = d * len(keys) / counts.sum() / alphabet
                found[1] = {"keys": keys, "kept": (counts - d) / counts.sum()}
                break
            contexts, at, types = np.unique(keys >> np.uint64(BITS), return_inverse=True, return_counts=True)
            total = np.bincount(at, counts)
            found[n] = {"keys": keys, "kept": (counts - d) / total[at], "contexts": contexts, "backoff": d * types / total}
            keys, counts = np.unique(_suffix(keys, n), return_counts=True)
        return found

    def _below(self, n: int, wanted: np.ndarray) -> np.ndarray:
        """Log probabilities of n-grams unseen at order n: back-off weight times the order below."""
        if n == 1:
            return np.repeat(self.unseen[None], len(wanted), 0)
        logs = self._order(n - 1, _suffix(wanted, n)).astype(np.float64)
        at, seen = _lookup(self.contexts[n], wanted >> np.uint64(BITS))
        logs[seen] += self.backoffs[n][at[seen]]
        return logs

    def _order(self, n: int, wanted: np.ndarray) -> np.ndarray:
        at, seen = _lookup(self.keys[n], wanted)
        logs = self.logs[n][at]
        if not seen.all():
            logs[~seen] = self._below(n, wanted[~seen])
        return logs

    def entropies(self, text: str) -> np.ndarray | None:
        """Cross-entropy in bits a symbol under every language; None without letters."""
        if not self.langs:
            return None
        if self.lut is None:
            self.lut = symbols(self.letters)
        total, n, letters = np.zeros(len(self.langs)), 0, False
        for found in grams(text, self.lut):
            letters = letters or bool(found.any())
            total += self._order(ORDER, found).sum(axis=0, dtype=np.float64)
            n += len(found)
        return -total / n if letters else None


def train(rows: DataFrame) -> Model | None:
    """Fit on all rows (lang, text) with neither null; None if the counts are too many for one model."""
    return model_of(*counted(rows))


def counted(rows: DataFrame) -> tuple[DataFrame, tuple[int, ...]]:
    """Written (lang, gram, n) over all rows (lang, text) with neither null, and the alphabet."""
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    letters = alphabet(rows)
    return written(count_grams(rows, letters), "grams"), letters


def model_of(counts: DataFrame, letters: tuple[int, ...], most: int = MOST_GRAMS) -> Model | None:
    if counts.count() > most:
        return None
    found = counts.orderBy("lang", "gram").toArrow()  # at most ``most`` rows
    lang = found["lang"].combine_chunks().dictionary_encode()
    code, names = lang.indices.to_numpy(zero_copy_only=False), lang.dictionary.to_pylist()
    gram, n = found["gram"].to_numpy().view(np.uint64), found["n"].to_numpy()
    return Model({x: (gram[code == k], n[code == k]) for k, x in enumerate(names)}, letters)


def entropies(df: DataFrame, model: Model, text: str = "text") -> Column:
    """Struct of the best language, its cross-entropy, and the margin to the second best."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,entropy:double,margin:double>")
    def best(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in batches:
            langs, low, margins = [], [], []
            for value in batch:
                e = m.entropies(value.as_py() or "")
                order = None if e is None else np.argsort(e, kind="stable")
                langs.append("und" if e is None else m.langs[order[0]])
                low.append(None if e is None else e[order[0]])
                margins.append(None if e is None else e[order[1]] - e[order[0]] if len(e) > 1 else BINS * BIN)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(low, pa.float64()),
                                              pa.array(margins, pa.float64())], ["lang", "entropy", "margin"])

    return best(F.col(text))


# --- models too large to be broadcast --------------------------------------------------

def probabilities(counts: DataFrame, letters: tuple[int, ...]) -> tuple[dict, dict, DataFrame]:
    """The model as tables: by order (lang, gram, log), by order (lang, context, back), and (lang, log) of a symbol
    unseen in a language."""
    level, discounts, by_order, back = counts, {}, {}, {}
    mask = lambda n: F.lit((1 << BITS * (n - 1)) - 1)
    levels = {}
    for n in range(ORDER, 0, -1):
        levels[n] = level
        some = level.groupBy("lang").agg(F.sum((F.col("n") == 1).cast("long")).alias("once"), F.sum((F.col("n") == 2).cast("long")).alias("twice"))
        discounts[n] = {r["lang"]: discount(r["once"], r["twice"]) for r in some.collect()}
        if n > 1:
            level = written(level.groupBy("lang", F.col("gram").bitwiseAND(mask(n)).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "counts")
    d = lambda n: F.coalesce(*[F.when(F.col("lang") == x, v) for x, v in sorted(discounts[n].items())], F.lit(0.5))
    total = levels[1].groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
    total = total.withColumn("unseen", d(1) * F.col("types") / F.col("total") / (len(letters) + 2))
    unseen = written(total.select("lang", "total", "unseen"), "unseen")
    one = levels[1].join(F.broadcast(unseen), "lang")       # one row a language
    by_order[1] = written(one.select("lang", "gram", ((F.col("n") - d(1)) / F.col("total") + F.col("unseen")).alias("p")), "order")
    for n in range(2, ORDER + 1):
        rows = levels[n].withColumns({"context": F.shiftrightunsigned("gram", BITS), "suffix": F.col("gram").bitwiseAND(mask(n))})
        ctx = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
        back[n] = written(ctx.select("lang", "context", "total", (d(n) * F.col("types") / F.col("total")).alias("back")), "contexts")
        below = by_order[n - 1].select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below"))
        rows = rows.join(back[n], ["lang", "context"]).join(below, ["lang", "suffix"])
        by_order[n] = written(rows.select("lang", "gram", ((F.col("n") - d(n)) / F.col("total") + F.col("back") * F.col("below")).alias("p")), "order")
    return by_order, back, unseen


def joined_entropies(rows: DataFrame, counts: DataFrame, letters: tuple[int, ...]) -> DataFrame:
    """(id, lang, entropy, margin) of rows (id, text) whose text has a letter, by joins: each distinct four-gram
    of all texts is scored once for every language, then texts add up those of their own."""
    shared = rows.sparkSession.sparkContext.broadcast(letters)

    @F.arrow_udf("array<struct<gram:long,n:long>>")
    def own(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lut = symbols(shared.value)
        for batch in batches:
            found = []
            for value in batch:
                parts = [np.unique(g, return_counts=True) for g in grams(value.as_py() or "", lut)]
                keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True) if parts else (np.zeros(0, np.uint64), [])
                n = np.bincount(at, np.concatenate([p[1] for p in parts])) if len(keys) else []
                found.append([{"gram": int(k), "n": int(c)} for k, c in zip(keys.view(np.int64), n)] if keys.any() else [])
            yield pa.array(found, pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())])))

    texts = written(rows.select("id", F.inline(own("text"))), "text_grams")
    by_order, back, unseen = probabilities(counts, letters)
    every = F.array(*[F.struct(F.lit(r["lang"]).alias("lang"), F.lit(r["unseen"]).alias("base")) for r in unseen.collect()])
    scored = texts.select("gram").distinct().select("gram", F.inline(every))
    key = F.col("gram")
    p = F.col("base")
    for n in range(1, ORDER + 1):
        part = key.bitwiseAND(F.lit((1 << BITS * n) - 1)) if n < ORDER else key
        scored = scored.withColumn("part", part)
        seen = by_order[n].select("lang", F.col("gram").alias("part"), F.col("p").alias(f"p{n}"))
        scored = scored.join(seen, ["lang", "part"], "left").drop("part")
        if n > 1:
            scored = scored.withColumn("context", F.shiftrightunsigned(part, BITS)).join(
                back[n].select("lang", "context", F.col("back").alias(f"b{n}")), ["lang", "context"], "left").drop("context")
            p = F.coalesce(f"p{n}", F.coalesce(f"b{n}", F.lit(1.0)) * p)
        else:
            p = F.coalesce("p1", p)
    scored = written(scored.select("gram", "lang", F.log2(p).alias("log")), "scores")
    total = texts.join(scored, "gram").groupBy("id", "lang").agg((-F.sum(F.col("n") * F.col("log")) / F.sum("n")).alias("entropy"))
    both = total.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("entropy", "lang"))).alias("e"))   # one entry a language
    second = F.when(F.size("e") > 1, F.col("e")[1]["entropy"] - F.col("e")[0]["entropy"]).otherwise(BINS * BIN)
    return both.select("id", F.col("e")[0]["lang"].alias("lang"), F.col("e")[0]["entropy"].alias("entropy"), second.alias("margin"))


def calibrated(scored: DataFrame) -> tuple[list[float], dict[str, float]]:
    """From rows (lang, pred, entropy, margin) with a known language: the probability of being
    right for each bin of margins, never falling, and the rejection limit of each language."""
    bins = scored.groupBy(margin_bin(F.col("margin")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("lang") == F.col("pred")).cast("long")).alias("right")).collect()
    n, right = np.full(BINS, 1e-6), np.full(BINS, 1e-6)
    for r in bins:
        n[r["bin"]], right[r["bin"]] = r["n"] + 1.0, r["right"] + 0.5
    groups = [[right[0], n[0], 1]]
    for k in range(1, BINS):
        groups.append([right[k], n[k], 1])
        while len(groups) > 1 and groups[-2][0] / groups[-2][1] > groups[-1][0] / groups[-1][1]:
            a = groups.pop()
            groups[-1] = [x + y for x, y in zip(groups[-1], a)]
    chance = [float(min(g[0] / g[1], 1.0)) for g in groups for _ in range(g[2])]
    limits = scored.where("lang = pred").groupBy("lang").agg(
        (F.avg("entropy") + REJECT_SIGMAS * F.coalesce(F.stddev_pop("entropy"), F.lit(0.0))).alias("limit")).collect()
    return chance, {r["lang"]: r["limit"] for r in limits}


def margin_bin(margin: Column) -> Column:
    return F.least(F.floor(margin / BIN), F.lit(BINS - 1)).cast("int")


def identify(df: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
             most: int = MOST_GRAMS) -> DataFrame:
    """(key, learned, lang_pred, score, rejected, entropy): every row; only rows where ``learn``
    holds teach the models, the calibration and the limits."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"), learn.alias("learn"))
    apart = F.pmod(F.xxhash64("text"), F.lit(FOLDS)) == 0
    counts, letters = counted(rows.where("learn").where(~apart).select("lang", "text"))
    model = model_of(counts, letters, most)
    if model is not None:
        scored = rows.select("key", "lang", "learn", apart.alias("apart"), entropies(rows, model).alias("b")) \
            .select("key", "lang", "learn", "apart", F.col("b.lang").alias("pred"), "b.entropy", "b.margin")
    else:
        digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
        narrow = written(rows.select("key", "lang", "learn", apart.alias("apart"), digest.alias("id")), "rows")
        texts = rows.select(digest.alias("id"), "text").dropDuplicates(["id"])
        found = written(joined_entropies(texts, counts, letters).withColumnRenamed("lang", "pred"), "joined")
        scored = lookup_join(narrow, found, "id", "left").select(
            "key", "lang", "learn", "apart", F.coalesce("pred", F.lit("und")).alias("pred"), "entropy", "margin")
    scored = written(scored, "entropies")
    chance, limits = calibrated(scored.where("learn AND apart AND lang IS NOT NULL AND entropy IS NOT NULL"))
    limit = F.coalesce(*[F.when(F.col("pred") == x, v) for x, v in sorted(limits.items())], F.lit(None).cast("double"))
    score = F.when(F.col("margin").isNotNull(), F.element_at(F.array(*map(F.lit, chance)), margin_bin(F.col("margin")) + 1))
    return scored.select(F.col("key").alias(key), F.col("learn").alias("learned"), F.col("pred").alias("lang_pred"),
                         F.coalesce(score, F.lit(0.0)).alias("score"),
                         F.coalesce(F.col("entropy") > limit, F.col("entropy").isNull()).alias("rejected"), "entropy")


def op1_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = identify(docs, ~held_out(F.col("doc_id")))
    return rows.select("doc_id", (~F.col("learned")).alias("held_out"), "lang_pred", "score", "rejected", "entropy")
