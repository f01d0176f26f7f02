"""Every operator on awkward rows, against brute force."""

import base64
import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

from quire.llm import bpe, langid, pii, shards, simhash, sketch, stages, tokens, toxicity, warc, winnow  # noqa: E402
from quire.llm.common import held_out  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, d string, digest int"
LONG = " ".join(f"word{i % 977} and Other{i % 31}" for i in range(20_000))
ITEM = "Alpha beta GAMMA delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"


def rows():
    texts = [None, "", "  \n\t ", "one", "Hello  big\n\n world, isn't it?  ", LONG, LONG + " end", "same text here now then",
             "same text here now then", f"before {ITEM.lower()} after", "é ñ ü Ж 日本語 🙂 <|endoftext|>", "12 345 !!! ---"]
    out = [(i, t, "en", None, None if t is None else len(t), "k", "d", 1) for i, t in enumerate(texts)]
    return [*out, out[4], (None, "no key at all", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


def texts():
    return [r[1] or "" for r in rows()]


def test_byte_bpe_has_one_worker_a_task(docs):
    plan = bpe.digests(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_byte_bpe_equals_the_library(docs):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, path, P.PATTERN).collect())
    want = []
    for t in texts():
        ids = enc.encode_ordinary(t)
        want.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(want)
    vocab = bpe.vocabulary(open(path, "rb").read(), P.PATTERN)
    base = "plain words that go on, and on\n  until they end here"
    ids = vocab.encode(base).tolist()
    for at, gone, new in [(len(base), 0, " tail's"), (0, 3, "X"), (14, 5, "  "), (30, 2, ""), (7, 0, "日本")]:
        edited = base[:at] + new + base[at + gone:]
        assert vocab.edit_text(base, ids, at, gone, new) == enc.encode_ordinary(edited)
    assert vocab.append_text(base, ids, "s more") == enc.encode_ordinary(base + "s more")
    word = "undernourishments".encode()
    assert vocab.last_tokens(word, vocab.last_tokens(word[:9])) == vocab.last_tokens(word)
    assert bpe.digests(docs.limit(0), path, P.PATTERN).count() == 0


def test_token_counts_and_the_cache(docs, spark, tmp_path):
    from tokenizers import Tokenizer

    path, cache = P.path("word_bpe_49k.json"), f"file://{tmp_path}/cache"
    library = Tokenizer.from_file(path)
    want = sorted((len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for t in texts())
    half = docs.where("doc_id < 6")
    tokens.content_counts(half, path, cache)
    first = spark.read.parquet(cache).count()
    assert sorted((r.n_bytes, r.n_tokens) for r in tokens.limits(docs, path, cache).collect()) == want
    assert spark.read.parquet(cache).count() == len(set(texts())) > first  # only misses were appended
    whole = tokens.count_tokens(docs, path, cache)
    assert whole.columns == [*docs.columns, "n_tokens"] and whole.count() == len(want)
    assert tokens.limits(docs.limit(0), path, cache).count() == 0


def brute_fingerprint(text):
    import xxhash

    low = text.translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[k:k + 4]).encode(), 42) for k in range(max(len(w) - 3, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_groups(docs):
    got = simhash.near_duplicates(docs).collect()
    fps = [brute_fingerprint(t) for t in texts()]
    ids = [r[0] for r in rows()]
    group = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(len(fps)):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    least = {g: min((i for i, h in zip(ids, group) if h == g and i is not None), default=None) for g in group}
    want = sorted((str(i), f % 2 ** 64, str(least[g])) for i, f, g in zip(ids, fps, group))
    assert sorted((str(r.doc_id), r.fp % 2 ** 64, str(r.smallest)) for r in got) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_gray_index_finds_every_near_pair():
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 150, dtype=np.uint64)
    x = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)) for _ in range(6)]]))
    rank = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    x = x[np.argsort(rank)]
    want = {(k, k + 1 + int(m)) for k in range(len(x)) for m in np.flatnonzero(np.bitwise_count(x[k] ^ x[k + 1:]) <= 4)}
    tree = simhash._levels(x)
    assert {(int(a), int(b)) for i, j in simhash._near(tree, tree, True, 4) for a, b in zip(i, j)} == want
    y, z = x[:300], x[300:]
    found = sum(len(i) for i, _ in simhash._near(simhash._levels(y), simhash._levels(z), False, 4))
    assert found == sum(int((np.bitwise_count(v ^ z) <= 4).sum()) for v in y)


def test_blocks_meet_through_the_tree_over_them(spark, monkeypatch):
    """Many small blocks under a tree of several levels link what a single look at all pairs links."""
    import numpy as np

    monkeypatch.setattr(simhash, "SMALL_BLOCK", 16)
    monkeypatch.setattr(simhash, "NODES", 3)
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)
    x = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for _ in range(5)]]))
    u, v = simhash.forest(x, None, 4)
    want = {}
    for a, b in zip(u.tolist(), v.tolist()):
        want.setdefault(a, set()).add(b)
        want.setdefault(b, set()).add(a)

    def groups(pairs):
        label = {int(k): int(k) for k in x.view(np.int64)}
        for a, b in pairs:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = {k: new if g == old else g for k, g in label.items()}
        return label

    df = spark.createDataFrame([(int(k),) for k in x.view(np.int64)], "fp long")
    got = [(r.u, r.v) for r in simhash.links(df).collect()]
    assert groups(got) == groups([(int(a), int(b)) for a, b in zip(u.view(np.int64), v.view(np.int64))])
    # Every pair of blocks that holds a near pair is found, and some are ruled out.
    order = np.argsort(x)
    placed = spark.createDataFrame([(int(f), k // 16) for k, f in enumerate(x.view(np.int64)[order])], "fp long, block int")
    kept = {(r.x, r.y) for r in simhash.near_blocks(placed, len(x) // 16 + 1, 4).collect()}
    sort = x[order]
    need = {(a // 16, b // 16) for a in range(len(sort)) for b in range(a, len(sort)) if int(sort[a] ^ sort[b]).bit_count() <= 4}
    n = len(sort) // 16 + 1
    assert need <= kept and len(kept) < n * (n + 1) // 2


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30))


def test_sketches_against_exact_sets(docs, spark):
    got = {(r.doc_id, r.n_chars): r for r in sketch.edited(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect()}
    own = {r[0]: r[1] or "" for r in rows() if r[0] is not None}
    order = sorted(own, reverse=True)

    def shingles(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    def alike(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    for k, i in enumerate(order):
        text, after = own[i], own[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[(i, len(text))]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - alike(shingles(text), shingles(edited))) < 0.2
        assert abs(r.near_next - alike(shingles(text), shingles(after))) < 0.2
    assert sketch.edited(docs).count() == len(rows()) and sketch.edited(docs.limit(0)).count() == 0
    parts = spark.createDataFrame([("a", "x y z u v w"), ("a", "u v w p q r"), ("b", "")], "g string, text string")
    parts = sketch.with_sketch(parts, F.col("text"), "s")
    merged = {r.g: r.s for r in sketch.merge_parts(parts, "g", "s").collect()}
    assert merged["a"] == sorted({h for r in parts.where("g = 'a'").collect() for h in r.s}) and merged["b"] == []


def test_sketch_estimators(spark):
    """Exact below k shingles; near the truth above."""
    def say(a, b):
        return " ".join(f"w{k}" for k in range(a, b))
    # (first, second): nothing, equal, disjoint, one within the other, half; small and large
    pairs = [("", ""), ("", say(0, 9)), (say(0, 40), say(0, 40)), (say(0, 40), say(100, 140)), (say(0, 30), say(0, 90)), (say(0, 60), say(30, 90)),
             (say(0, 4000), say(0, 4000)), (say(0, 4000), say(2000, 6000)), (say(0, 1500), say(0, 6000))]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    df = sketch.with_sketch(sketch.with_sketch(df, F.col("a"), "sa"), F.col("b"), "sb")
    got = df.select("sa", "sb", sketch.resemblance(F.col("sa"), F.col("sb")).alias("r"), sketch.containment(F.col("sa"), F.col("sb")).alias("c"),
                    sketch.distinct_shingles(F.col("sa")).alias("n"), sketch.merged(F.col("sa"), F.col("sb")).alias("m")).orderBy("k").collect()

    def shingles(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    for (a, b), r in zip(pairs, got):
        x, y = shingles(a), shingles(b)
        small = len(x | y) < sketch.K
        near = 1e-9 if small else 0.15
        assert abs(r.r - (len(x & y) / len(x | y) if x | y else 1.0)) <= near
        assert abs(r.c - (len(x & y) / len(x) if x else 1.0)) <= (near if small else 0.3)
        assert abs(r.n - len(x)) <= (1e-9 if len(x) < sketch.K else 0.3 * len(x))
        assert r.sa == sorted(r.sa) and len(r.sa) == min(len(x), sketch.K) and len(set(r.sa)) == len(r.sa)
        assert r.m == sorted(set(r.sa) | set(r.sb))[:sketch.K]
    hashes = [spark.sql(f"SELECT xxhash64(array({', '.join(f'xxhash64(cast({w!r} as string))' for w in s)})) AS h").first().h
              for s in sorted(shingles(say(0, 9)))]
    own = sketch.with_sketch(spark.createDataFrame([(say(0, 9),)], "t string"), F.col("t"), "s").first().s
    assert own == sorted(hashes)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))


def test_decontamination_with_short_and_repeated_items(docs, spark):
    items = [(1, ITEM), (2, "same text"), (3, "text"), (4, None), (5, "!!"), (None, "big world"), (2, "same text"), (6, "É ñ")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in winnow.decontaminate(docs, bench).collect())
    want = []
    for r in rows():
        w, hit, ids = words(r[1] or ""), set(), set()
        for i, t in items:
            v = words(t or "")
            n = min(13, len(v))
            windows = {tuple(v[j:j + n]) for j in range(len(v) - n + 1)} if v else set()
            for p in range(len(w) - n + 1):
                if windows and tuple(w[p:p + n]) in windows:
                    hit |= set(range(p, p + n))
                    ids.add("null" if i is None else str(i))
        want.append((str(r[0]), len(w), len(hit), sorted(ids)))
    assert got == sorted(want)
    assert winnow.decontaminate(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert winnow.decontaminate(docs.limit(0), bench).count() == 0


def test_shards_are_equal_and_gapless(docs):
    got = shards.shard(docs).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len(t.encode()) + 16, zlib.crc32(t.encode())) for t in texts())
    for s in {r.shard for r in got}:
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own))) and 0 <= s < 40
    total, most = sum(r.size for r in got), max(r.size for r in got)
    assert all(sum(r.size for r in got if r.shard == s) <= total / 40 + 2 * most for s in range(40))
    assert shards.shard(docs.limit(0)).count() == 0


def test_warc_round_trip(docs, tmp_path):
    folder = f"file://{tmp_path}/out"
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a/b c\n").alias("url"), F.col("text").alias("html"), "key")
    manifest = warc.write_warc(pages, folder, roll=20_000)
    got = warc.read_warc(manifest, folder).collect()
    largest = {}
    for r in rows():
        largest[r[1] or ""] = max(largest.get(r[1] or "", -1), -1 if r[0] is None else r[0])
    assert len(got) == len(rows())
    for r in got:
        if r.record_type == "response":
            assert largest[r.payload.decode()] == (-1 if r.key is None else r.key) and r.refers_to is None
            assert r.payload_digest == base64.b32encode(hashlib.sha1(r.payload).digest()).decode()
    assert sum(r.record_type == "response" for r in got) == len(largest)
    again = warc.write_warc(pages, f"file://{tmp_path}/again", roll=20_000)
    key = lambda m: sorted((r.name, r.sha256, r.records) for r in m.collect())
    assert key(manifest) == key(again)
    assert not (tmp_path / "out" / "_temporary").exists() or not list((tmp_path / "out" / "_temporary").iterdir())
    empty = warc.write_warc(pages.limit(0), f"file://{tmp_path}/none")
    assert warc.read_warc(empty, f"file://{tmp_path}/none").count() == 0


def test_surrogates_keep_kind_coreference_and_distinctness(spark):
    texts_ = ["Write to Ann.Lee@mail.example.org or ann.lee@mail.example.org, call +1 (017) 555-7713.",
              "card 4111111111111111, 4111 1111 1111 1111 and +1 (017) 555-7713", "Mrs Anna Berg met Mr. Karl Berg; Mrs Anna left",
              None, "", "no data, 12 apples, 3.5 %", "ip 97.51.17.173."]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts_)], "doc_id long, text string, d string, new string")
    got = [r.text for r in pii.replace(df, count="n").orderBy("doc_id").collect()]
    assert got[3:6] == [None, "", "no data, 12 apples, 3.5 %"]
    mails = re.findall(r"\S+@\S+(?=,| or)", got[0])
    assert mails[0] == mails[1].lower() or mails[0].lower() == mails[1].lower()
    phone = re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[0])[0]
    assert phone in got[1] and phone != "+1 (017) 555-7713"
    cards = re.findall(r"\d{16}|\d{4} \d{4} \d{4} \d{4}", got[1])
    assert cards[0] == cards[1].replace(" ", "") != "4111111111111111"
    digits = [int(c) for c in cards[0]][::-1]
    assert sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(digits)) % 10 == 0
    names = re.match(r"Mrs (\w+) (\w+) met Mr\. (\w+) (\w+); Mrs (\w+) left", got[2]).groups()
    assert names[0] == names[4] and not {"Anna", "Berg", "Karl"} & set(names)
    assert re.fullmatch(r"ip \d+(\.\d+){3}\.", got[6]) and "97.51.17.173" not in got[6]
    assert pii.replace(df.limit(0)).columns == df.columns
    found = spark.range(3000).select(F.lit("name-f").alias("kind"), F.concat(F.lit("Name"), "id").alias("value"))
    made = pii.surrogates(found, "k").collect()
    assert len({r.made for r in made}) == 3000


def test_language_and_toxicity_learn_from_their_rows_only(spark):
    lines = {"en": "the thing that they were thinking with this", "de": "der einung keit und nicht ungeheuer schön auch",
             "es": "ciónes que los para mañana señor como pero", "fr": "le eaux être très français avec leurs"}
    data = [(i, " ".join(lines[x].split()[k % 5:] + lines[x].split()[:k % 7]) * 3, x)
            for i, (k, x) in enumerate((k, x) for k in range(60) for x in lines)]
    data += [(1000, None, "en"), (1001, "123 !!", "en"), (None, "the thing", None), (0, data[0][1], "en")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = langid.identify(df, ~held_out(F.col("doc_id"))).collect()
    want = {d[0]: d[2] for d in data}
    judged = [r for r in got if r.doc_id is not None and r.doc_id < 1000]
    assert all(r.lang_pred == want[r.doc_id] and 0.5 < r.score <= 1 for r in judged) and len(got) == len(data)
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (1000, 1001)} == {("und", 0.0)}
    assert langid.identify(df.limit(0), F.lit(True)).count() == 0
    assert {r.lang_pred for r in langid.identify(df, F.lit(False)).collect()} == {"und"}

    bad = ["vile", "nasty", "awful"]
    text = spark.createDataFrame([(i, f"{lines['en']} {bad[i % 3] + ' ' + bad[(i + 1) % 3] if i % 4 == 0 else 'good day'} {i}", "x")
                                  for i in range(300)] + [(900, None, ""), (None, "vile nasty", ""), (0, "vile nasty day", "")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fitted(text, labels)
    out = {r.doc_id: r.p for r in text.select("doc_id", toxicity.scores(text, model).alias("p")).collect()}
    assert all((out[i] >= 0.7) == (i % 4 == 0) for i in range(300)) and out[900] < 0.5 and out[None] >= 0.7
    none = toxicity.fitted(text, labels.limit(0))
    assert none.score("vile") < 1e-6 and toxicity.fitted(text.limit(0), labels).lexicon == []


def test_stages_keep_columns_and_one_of_each_group(docs, spark):
    kept = stages.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids.count("4") == 1 and "8" not in ids and "7" in ids and "0" in ids and "1" not in ids
    out = stages.replace_personal_data(spark, docs, "")
    assert out.columns == docs.columns and out.count() == docs.count()


def test_surrogates_for_names_numbers_and_keys_of_many_forms(spark):
    wide = [("Mr O'Brien's dog", "O'Brien"), ("Mr J. Smith came", "J. Smith"), ("Mr John Ronald Smith came", "John Ronald Smith"),
            ("Herr 田中 kam", "田中"), ("Prof. Dr. Anna von Berg came", "Anna Berg"), ("call +15551234567 now", "15551234567"),
            ("call +49 30 1234567 now", "1234567"), ("call 0170 1234567 now", "1234567"), ("call 01 23 45 67 89 now", "23 45 67 89"),
            ("at 2001:db8:85a3::8a2e:370:7334 now", "85a3 8a2e 7334"), ("pay 3782 822463 10005 now", "822463 10005"),
            ("key ghp_abcdefghijklmnopqrstuvwxyz0123456789 now", "abcdefghijklmnopqrstuvwxyz0123456789"),
            ("key sk-abcd1234EFGH5678ijkl9012 now", "abcd1234EFGH5678ijkl9012")]
    plain = ["on 01.02.2024 12:30 std::a and a::b 3.14159", "sk-learn and from 1999 to 2004, 12,345,678"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([t for t, _ in wide] + plain)], "doc_id long, text string")
    got = [r.text for r in pii.replace(df).orderBy("doc_id").collect()]
    for (text, gone), new in zip(wide, got):
        assert not [x for x in gone.split() if x in new], (text, new)
        assert (new.split()[0], new.split()[-1]) == (text.split()[0], text.split()[-1])
    assert got[len(wide):] == plain


def test_surrogates_of_a_name_do_not_depend_on_its_title(spark):
    texts_ = ["Dr Berg met Mr Berg; later Berg wrote, Berg's Bergen and Berg@mail.org", "Mrs Anna Berg came. Anna Berg, Anna",
              "Berg is a mountain", "Herr 田中 kam, 田中さん"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts_)], "doc_id long, text string")
    got = [(r.text, r.n) for r in pii.replace(df, count="n").orderBy("doc_id").collect()]
    berg = got[0][0].split()[1]
    assert re.fullmatch(rf"Dr {berg} met Mr {berg}; later {berg} wrote, {berg}'s Bergen and \w+@\w+\.example", got[0][0]) and got[0][1] == 5
    anna = got[1][0].split()[1]
    assert got[1] == (f"Mrs {anna} {berg} came. {anna} {berg}, {anna}", 4) and len({anna, berg, "Anna", "Berg"}) == 4
    assert got[2] == (texts_[2], 0)
    assert "田中" not in got[3][0] and got[3][0].split()[1].rstrip(",") + "さん" == got[3][0].split()[-1]


def test_surrogates_differ_over_titles_and_domains(spark):
    values = [("name-" + g, f"Name{i}") for i in range(2000) for g in "fmn"[i % 3]] + [("name-m", "Name0")]
    values += [("email", f"joe@{a}{b}.{t}") for a in "abcdefghijklm" for b in "nopqrstuvwxyz" for t in ("com", "org")]
    # real names that are surrogates of others
    found = spark.createDataFrame(values, "kind string, value string")
    first = {r.value: r.made for r in pii.surrogates(found, "k").collect()}
    taken = [("name-n", first["Name3"]), ("name-f", first["Name4"])]
    made = pii.surrogates(found.unionByName(spark.createDataFrame(taken, found.schema)), "k").collect()
    names = {r.value: r.made for r in made if r.kind != "email"}
    assert len(names) == 2002 == len(set(names.values())) and not set(names) & set(names.values())
    domains = {r.value: r.made.split("@")[1] for r in made if r.kind == "email"}
    assert len(domains) == 338 == len(set(domains.values()))


def test_surrogates_do_not_run_out(spark):
    # One accented letter has 22 surrogates of its length.
    found = spark.createDataFrame([("email", f"{x}@mail.org") for x in "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāēī"], "kind string, value string")
    made = [r.made for r in pii.surrogates(found, "k").collect()]
    assert len(set(made)) == 30 and len({m.split("@")[1] for m in made}) == 1


def test_shards_expand_copies_in_many_tasks_and_ranges_grow(spark, monkeypatch):
    one = spark.range(1).select(F.lit(10_500).cast("long").alias("copies"), F.lit("a").alias("digest"), F.lit(1).alias("key"))
    got = shards.expanded(one).withColumn("task", F.spark_partition_id())
    assert [r.copy for r in got.select("copy").orderBy("copy").collect()] == list(range(10_500))
    assert got.groupBy("task").count().agg(F.max("count")).first()[0] < 10_500
    df = spark.range(3000).select("id", F.when(F.col("id") < 1500, "copy").otherwise(F.col("id").cast("string")).alias("text"))
    df = df.select(F.when(F.col("id") < 1500, 0).otherwise(F.col("id")).alias("doc_id"), "text")
    order = sorted((hashlib.md5(r.text.encode()).hexdigest(), r.doc_id, len(r.text) + 16) for r in df.collect())
    total, at, want, slots = sum(o[2] for o in order), 0, [], {}
    for _, doc, size in order:  # every text stands alone but the large group, which is cut
        shard = at * 40 // total
        want.append((doc, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
        at += size
    asked, of = [], shards.splitters
    monkeypatch.setattr(shards, "splitters", lambda rows, total, ranges: asked.append(ranges) or of(rows, total, ranges))
    monkeypatch.setattr(shards, "RANGE_BYTES", 300)
    assert sorted((x.doc_id, x.shard, x.slot) for x in shards.shard(df).collect()) == sorted(want) and asked[0] > shards.RANGES
