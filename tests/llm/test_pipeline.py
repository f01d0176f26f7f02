"""The pipeline, stage by stage and whole, against plain Python."""

import base64
import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from quire.llm import stages, toxicity  # noqa: E402
from test_llm_operators import brute_fingerprint, words  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BAD = ["vile", "nasty", "awful", "wretched"]


def documents():
    rng = random.Random(11)
    pool = [f"{a}{b}" for a in ("lo", "mi", "ne", "pa", "ru", "sa", "te") for b in ("na", "ri", "so", "vu", "mel", "dor", "kin")]
    say = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    rows = []
    for k in range(240):
        text = say(rng.randint(30, 80))
        if k % 4 == 0:
            text = f"{BAD[k // 4 % 4]} {text[:80]} {BAD[(k // 4 + 1) % 4]} {text[80:]} {BAD[(k // 4 + 2) % 4]}"
        rows.append([k, text])
    rows += [[300, say(60) + " write to ann.lee@mail.example.org or call +1 (487) 555-7209 now"],
             [301, "Mrs Anna Berg met Mr Karl Berg. " + say(40)], [302, None], [303, ""], [304, "  \n"], [305, "one"],
             [306, " ".join(ITEM) + " end"], [307, say(50) + " " + " ".join(ITEM) + " " + say(20)],
             [308, say(30_000)], [309, rows[1][1]], [310, rows[1][1] + " end"], [1, rows[1][1]], [None, say(40)], [None, rows[2][1]]]
    rows += [[400 + k, rows[5][1]] for k in range(100)]      # many copies
    return [(i, t, "en", None if k % 5 else "web", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]


ITEM = [f"bench{k}" for k in range(20)]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(documents(), SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, " ".join(ITEM)), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(240)] + [(5, None, None)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def plain_dedup(rows):
    """One of each group of near fingerprints: the smallest key, nulls last, then the smaller digest."""
    fps = [brute_fingerprint(r[1] or "") for r in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if group[a] != group[b] and (fps[a] ^ fps[b]).bit_count() <= 4:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    order = lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())
    best = {}
    for r, g in zip(rows, group):
        if g not in best or order(r) < order(best[g]):
            best[g] = r
    return sorted(best.values(), key=str)


def plain_clean(rows):
    kept, size = [], 13
    windows = {tuple(ITEM[k:k + size]) for k in range(len(ITEM) - size + 1)}
    for r in rows:
        w, hit = words(r[1] or ""), set()
        for k in range(len(w) - size + 1):
            if tuple(w[k:k + size]) in windows:
                hit |= set(range(k, k + size))
        if not (hit and 20 * len(hit) >= len(w)):
            kept.append(r)
    return sorted(kept, key=str)


def test_every_stage_equals_plain_python(spark, sf):
    import tiktoken

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = rows_of(docs)
    model = toxicity.fitted(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = stages.drop_toxic(spark, docs, sf)
    want = [r for r in rows if model.score(r[1] or "") < toxicity.THRESHOLD]
    assert kept.columns == docs.columns and rows_of(kept) == want
    gone = {r[0] for r in rows} - {r[0] for r in want}
    assert {k for k in range(240) if k % 4 == 0} >= gone and len(gone) >= 50

    alone = stages.drop_near_duplicates(spark, kept, sf)
    want = plain_dedup(want)
    assert alone.columns == docs.columns and rows_of(alone) == want and len(want) < 200

    clean = stages.drop_contaminated(spark, alone, sf)
    want = plain_clean(want)
    ids = {r[0] for r in want}
    assert clean.columns == docs.columns and rows_of(clean) == want and 306 not in ids and 307 not in ids

    private = stages.replace_personal_data(spark, clean, sf)
    got = rows_of(private)
    new, old = {(r[0], r[1]): r for r in got}, {(r[0], r[1]): r for r in want}
    changed = [r for r in got if (r[0], r[1]) not in old]
    assert private.columns == docs.columns and len(got) == len(want) and {r[0] for r in changed} == {300, 301}
    assert all(r[4] == len(r[1]) for r in changed) and set(new) - {(r[0], r[1]) for r in changed} <= set(old)
    assert not re.search("ann.lee|555-7209|Anna|Karl|Berg", " ".join(r[1] for r in changed))

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in got:
        tokens = enc.encode_ordinary(r[1] or "")
        want.append((r[0], len(tokens), hashlib.sha256(",".join(map(str, tokens)).encode()).hexdigest(),
                     hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert rows_of(stages.tokenize(spark, private, sf)) == sorted(want, key=str)


def test_the_whole_run_cleans_up_behind_itself(spark, sf):
    root = spark.conf.get("spark.checkpoint.dir") + "/quire"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    got = rows_of(corpus_pipeline.run(spark, sf))
    assert {x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before} == {"pipeline-byte_bpe"}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    # Surrogates depend on the application's key alone, so both runs agree.
    assert got == rows_of(docs)


def test_stages_with_odd_columns_and_no_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({c: F.lit("x") for c in ("bad", "own_id", "own_digest", "__d", "__new")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() > 0, name
        assert out.agg(F.count_distinct("bad", "own_id", "own_digest", "__d", "__new")).first()[0] == 1
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_of_repeated_rows_one_stays(spark):
    rows = [(1, "same words here all day long", "en", s, 5) for s in ("a", "b", "b", None)] + [(2, "other things are said there now", "en", "c", 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = [rows_of(stages.drop_near_duplicates(spark, df.repartition(n), "")) for n in (1, 4)]
    assert kept[0] == kept[1] and len(kept[0]) == 2
