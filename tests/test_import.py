"""Scenario fixtures for the import modes (FIXTURES.md section 3), on real .txt.gz dumps."""

import datetime as dt
import os
import tempfile
import time

import pytest

from dumps import author, edition, line, work, write_dump
from quire.plans.importer import ImportModeError, run_import
from quire.sources.dumps import DumpNotFound, find_dump, read_dump_lines, split_rows
from quire.sources.store import TableStore

T1 = dt.datetime(2025, 1, 1, 12, 0, 0)
T2 = dt.datetime(2025, 2, 1, 12, 0, 0)


def _dir(name):
    return tempfile.mkdtemp(prefix=f"quire-{name}-")


def _rows(store, table, cols):
    df = store.read(table).select(*cols)
    return sorted(tuple(r) for r in df.collect())


def _catalogue(d):
    write_dump(d, "editions", [
        edition("OL1M", title="A B", works=[{"key": "/works/OL1W"}], languages=[{"key": "/languages/eng"}],
                isbn_13=["9780000000002"], covers=[5], publish_date="March 2005", number_of_pages="12"),
        edition("OL2M", title="Solo", works=[{"key": "/works/OL1W"}], languages=[{"key": "/languages/fre"}]),
        edition("OL3M", title="Lost", works=[{"key": "/works/OL9W"}], languages=[{"key": "/languages/eng"}]),
        edition("OL4M", title="German", works=[{"key": "/works/OL2W"}], languages=[{"key": "/languages/ger"}]),
        edition("OL5M", title="Nowork", languages=[{"key": "/languages/eng"}]),
        line("/type/edition", "/books/OL6M", "{not json"),
        edition("OL7M", title="Lost", works=[{"key": "/works/OL3W"}], languages=[{"key": "/languages/eng"}]),
    ], members=2)
    write_dump(d, "works", [
        work("OL1W", title="John Smith", authors=[{"author": {"key": "/authors/OL1A"}}, {"author": "/authors/OL2A"}]),
        work("OL2W", title="Other", authors=[{"author": {"key": "/authors/OL3A"}}]),
        work("OL3W", title="John  Smith!", authors=[{"author": {"key": "/authors/OL1A"}}]),
        work("OL4W", subtitle="untitled"),
    ])
    write_dump(d, "authors", [
        author("OL1A", name="John Smith", bio={"type": "/type/text", "value": " bio "}),
        author("OL2A", personal_name="X"),
        author("OL3A", name="Dropped"),
        author("OL4A"),
    ])


def test_split_and_scan(spark):
    d = _dir("scan")
    write_dump(d, "works", [
        "/type/work\t/works/OL1W\t3\t2020\t{\"title\":\"A\"}",
        "a\tb\tc\td\t{x\ty}",
        "a\tb\tc\td",
        "",
        "a\tb\tc\td\t",
        "a\tb\tc\td\t{\"x\":1}\r{bare CR inside}",
    ], members=3)
    rows = split_rows(read_dump_lines(spark, find_dump(spark, d, "works"), 4)).orderBy("line_no").collect()
    assert [r["cols_ok"] for r in rows] == [True, True, False, False, True, True]
    assert rows[5]["json"] == '{"x":1}\r{bare CR inside}'
    assert rows[0]["key"] == "/works/OL1W" and rows[0]["json"] == '{"title":"A"}'
    assert rows[1]["json"] == "{x\ty}"
    assert rows[4]["json"] == ""


def test_find_newest_dump(spark):
    d = _dir("find")
    old = write_dump(d, "authors", [author("OL1A", name="a")], name="2024-01-01")
    new = write_dump(d, "authors", [author("OL1A", name="b")], name="2025-01-01")
    os.utime(old, (time.time(), time.time() + 100))
    assert find_dump(spark, d, "authors").endswith(os.path.basename(old))
    os.utime(new, (time.time(), time.time() + 200))
    assert find_dump(spark, d, "authors").endswith(os.path.basename(new))
    with pytest.raises(DumpNotFound):
        find_dump(spark, d, "works")


def test_full_import_and_reimport(spark):
    d, root = _dir("dumps"), _dir("store")
    _catalogue(d)
    rep = run_import(spark, d, root, run_ts=T1)
    assert rep.scans["editions"] == {"written": 4, "malformed": 1, "no_work": 1, "wrong_language": 1}
    store = TableStore(spark, root)
    # Cascade: OL1W and OL3W have a staged edition (OL9W is unknown, OL2W's is German).
    assert _rows(store, "works", ["open_library_id", "slug", "edition_count"]) == [
        ("OL1W", "john-smith", 2), ("OL3W", "john-smith--2", 1)]
    assert _rows(store, "authors", ["open_library_id", "name", "slug", "bio", "works_count"]) == [
        ("OL1A", "John Smith", "john-smith", "bio", 2), ("OL2A", "X", "x", None, 1)]
    # OL3M's work is unknown: dropped, but it used up the first number of base `lost`.
    assert _rows(store, "editions", ["open_library_id", "slug", "page_count", "published_year"]) == [
        ("OL1M", "9780000000002-a-b", 12, 2005), ("OL2M", "solo", None, None), ("OL7M", "lost--2", None, None)]
    assert len(store.read("authorships").collect()) == 3
    before = {t: _rows(store, t, [c for c in store.read(t).columns if c != "updated_at"])
              for t in ("authors", "works", "editions", "authorships")}
    run_import(spark, d, root, run_ts=T2)
    for t, rows in before.items():
        assert _rows(store, t, [c for c in store.read(t).columns if c != "updated_at"]) == rows, t
    assert {r[0] for r in store.read("works").select("updated_at").collect()} == {T2}


def test_refresh_keeps_slug_and_only_modes(spark):
    d, root = _dir("dumps"), _dir("store")
    _catalogue(d)
    run_import(spark, d, root, run_ts=T1)
    store = TableStore(spark, root)
    d2 = _dir("dumps2")
    write_dump(d2, "works", [
        work("OL1W", title="Renamed", authors=[{"author": {"key": "/authors/OL2A"}}]),
        work("OL2W", title="Unknown work"),
    ])
    write_dump(d2, "authors", [author("OL1A", name="Johnny"), author("OL3A", name="New")])
    run_import(spark, d2, root, only="works", run_ts=T2)
    assert _rows(store, "works", ["open_library_id", "title", "slug"]) == [
        ("OL1W", "Renamed", "john-smith"), ("OL3W", "John  Smith!", "john-smith--2")]
    # Authorship (OL1W, OL2A) updated to position 0; works_count recomputed.
    run_import(spark, d2, root, only="authors", run_ts=T2)
    assert _rows(store, "authors", ["open_library_id", "name", "bio"]) == [
        ("OL1A", "Johnny", None), ("OL2A", "X", None)]
    with pytest.raises(ImportModeError):
        run_import(spark, d2, root, only="works", dev=True, run_ts=T2)


def test_only_editions_requires_works(spark):
    d, root = _dir("dumps"), _dir("store")
    _catalogue(d)
    with pytest.raises(ImportModeError):
        run_import(spark, d, root, only="editions", run_ts=T1)


def test_dev_subset(spark):
    d, root = _dir("dumps"), _dir("store")
    year = dt.datetime.now(dt.timezone.utc).year
    eds = []
    for i, (title, cover, date) in enumerate([
            (None, [1], "2000"), ("t", [], "2000"), ("t", [1], "1949"), ("t", [1], "1950"),
            ("t", [1], str(year + 1)), ("t", [1], str(year + 2)), ("t", [1], None)]):
        rec = {"works": [{"key": "/works/OL1W"}], "languages": [{"key": "/languages/eng"}], "covers": cover}
        if title:
            rec["title"] = title
        if date:
            rec["publish_date"] = date
        eds.append(edition(f"OL{i}M", **rec))
    write_dump(d, "editions", eds)
    write_dump(d, "works", [work("OL1W", title="W")])
    write_dump(d, "authors", [author("OL1A", name="A")])
    run_import(spark, d, root, dev=True, run_ts=T1)
    store = TableStore(spark, root)
    assert _rows(store, "editions", ["open_library_id", "published_year"]) == [("OL3M", 1950), ("OL4M", year + 1)]


def test_dev_cap_across_scan_partitions(spark):
    """E6 with lines spread over several files: the first n in file order, exactly."""
    from pyspark.sql import functions as F

    from quire.operators import stage as S

    d = _dir("multi")
    for part in range(3):
        os.makedirs(os.path.join(d, "dump"), exist_ok=True)
        write_dump(os.path.join(d, "dump"), "editions",
                   [edition(f"OL{part}{i:03d}M", title="t") for i in range(40)], name=f"part{part}")
    rows = split_rows(read_dump_lines(spark, os.path.join(d, "dump"), 4))
    parsed = S.parse_lines(rows)
    ordered = sorted((r["line_no"], r["olid"]) for r in parsed.select("line_no", "olid").collect())
    assert len({ln >> 33 for ln, _ in ordered}) == 3
    for n in (10, 40, 55, 120, 500):
        got = {r["olid"] for r in S.first_n_in_file_order(parsed.withColumn("revision", F.lit(1).cast("bigint")), n)
               .select("olid").collect()}
        assert got == {k for _, k in ordered[:n]}, n


def test_vacuum_keeps_newest_versions(spark):
    d, root = _dir("dumps"), _dir("store")
    _catalogue(d)
    run_import(spark, d, root, run_ts=T1)
    run_import(spark, d, root, run_ts=T2)
    store = TableStore(spark, root)
    before = _rows(store, "works", ["open_library_id", "slug"])
    assert store._versions("works")[-1] >= 4
    gone = store.vacuum("works", keep=1)
    assert gone and store._versions("works", committed_only=False) == [store.version("works")]
    assert _rows(store, "works", ["open_library_id", "slug"]) == before


def test_dump_lines_are_always_spread(spark, tmp_path):
    import gzip

    from quire.sources.dumps import read_dump_lines
    for n in range(3):
        with gzip.open(tmp_path / f"part{n}.txt.gz", "wt") as f:
            f.write("a\nb\r\nc\n")
    lines = read_dump_lines(spark, str(tmp_path), num_partitions=5)
    assert "repartition" in lines._jdf.queryExecution().logical().toString().lower()
    assert sorted(r.line for r in lines.collect()) == sorted("abc" * 3)


def test_store_absent_table_and_uncommitted_version(spark):
    from quire.operators.schemas import LIVE
    root = _dir("store")
    store = TableStore(spark, root, dict(LIVE))
    empty = store.read("works")
    assert empty.schema.names == LIVE["works"].names and empty.count() == 0 and store.is_empty("works")
    # A version without the commit marker (a crashed run) is never read.
    empty.write.parquet(f"{root}/works/v=1")
    assert store.version("works") is None
    assert store.write("works", empty) == 2 and store.version("works") == 2


def test_import_leaves_no_scratch_and_counts_links(spark):
    import os

    from quire.session import checkpoint_root
    root = os.path.join(checkpoint_root(spark), "quire")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    d, store = _dir("dumps"), _dir("store")
    _catalogue(d)
    first = run_import(spark, d, store, run_ts=T1)
    again = run_import(spark, d, store, run_ts=T2)
    assert first.merges["authorships"]["updated"] == 0 and first.merges["authorships"]["inserted"] > 0
    assert again.merges["authorships"] == {"updated": first.merges["authorships"]["inserted"], "inserted": 0}
    assert set(os.listdir(root)) - before == set()


def _folder_dump(d, kind, name, parts):
    """A dump of several files; ``parts`` are the lines of each, in order."""
    folder = os.path.join(d, f"ol_dump_{kind}_{name}")
    for k, lines in enumerate(parts):
        path = write_dump(folder, "x", lines, name=f"{k}")
        os.rename(path, os.path.join(folder, f"part-{k}.txt.gz"))
    return folder


def test_a_folder_of_files_is_a_dump(spark):
    d = _dir("folder with spaces, 100%")
    old = write_dump(d, "works", [work("OL9W", title="old")], name="2024-01-01")
    folder = _folder_dump(d, "works", "2024-02-01", [[f"a\tOL{k * 10 + i}W\t1\tt\t{{}}" for i in range(7)] for k in range(12)])
    os.utime(old, (1, 1))
    dump = find_dump(spark, d, "works")
    assert dump.endswith(os.path.basename(folder))
    # part-10 comes after part-9, not after part-1
    assert [os.path.basename(f) for f in dump.files] == [f"part-{k}.txt.gz" for k in range(12)]
    rows = split_rows(read_dump_lines(spark, dump, 4)).orderBy("line_no").collect()
    assert [r["key"] for r in rows] == [f"OL{k * 10 + i}W" for k in range(12) for i in range(7)]
    assert [r["line_no"] >> 33 for r in rows] == [k for k in range(12) for _ in range(7)]
    # A newer single file wins, and one file is a dump of one file.
    os.utime(old, (time.time() + 100, time.time() + 100))
    assert list(find_dump(spark, d, "works").files) == [find_dump(spark, d, "works")]
    with pytest.raises(DumpNotFound):
        find_dump(spark, d, "authors")
    with pytest.raises(DumpNotFound):
        find_dump(spark, os.path.join(d, "nowhere"), "works")


def test_import_of_a_folder_keeps_file_order(spark):
    from quire.plans.importer import ImportParams

    d, root = _dir("dumps"), _dir("store")
    full = dict(title="T", works=[{"key": "/works/OL1W"}], languages=[{"key": "/languages/eng"}], covers=[1], publish_date="2000")
    _folder_dump(d, "editions", "latest", [[edition(f"OL{k * 100 + 50 - i}M", **full) for i in range(5)] for k in range(11, -1, -1)])
    _folder_dump(d, "works", "latest", [[work("OL1W", title="W")], [work("OL2W", title="X")]])
    write_dump(d, "authors", [author("OL1A", name="A")])
    report = run_import(spark, d, root, dev=True, run_ts=T1, params=ImportParams(dev_limit=52))
    want = [f"OL{k * 100 + 50 - i}M" for k in range(11, -1, -1) for i in range(5)][:52]
    assert sorted(r[0] for r in TableStore(spark, root).read("editions").select("open_library_id").collect()) == sorted(want)
    assert report.scans["editions"]["written"] == 52


def test_the_cut_is_found_in_small_blocks(spark):
    from quire.operators import stage as S

    # 3 files; lines far apart, near each other, and twice the same.
    lines = [f << 33 | line for f in range(3) for line in [0, 1, 1, 5, 2047, 2048, 1 << 22, (1 << 22) + 3, (1 << 30) + 9]]
    df = spark.createDataFrame([(n, k) for k, n in enumerate(lines)], "line_no long, revision long").repartition(5)
    for n in [0, 1, 2, 3, 4, 7, 9, 10, 17, 18, 26, 27, 40]:
        got = sorted(r.revision for r in S.first_n_in_file_order(df, n).collect())
        assert got == list(range(min(n, len(lines)))), n


def test_records_with_repeated_keys(spark):
    """Known top-level fields must not repeat; anything else may, and the last value counts."""
    lines = ['{"title":"A","description":{"value":"x","value":"y"}}', '{"title":"A","title":"B"}', '{"q":1,"title":"A","q":2}',
             '{"title":"A","subjects":[{"k":1,"k":2},"s"]}', '{"title":"A","title":"B"', '{"title":"A"} x', '[{"title":"A"}]',
             '{"title":"A","authors":[{"author":{"key":"/authors/OL1A","key":"/authors/OL2A"}}]}', '"title"', "", '{"titl\\u0065":"A","title":"B"}']
    d, root = _dir("dumps"), _dir("store")
    write_dump(d, "editions", [edition(f"OL{k}M", title="E", works=[{"key": f"/works/OL{k}W"}], languages=[{"key": "/languages/eng"}])
                               for k in range(len(lines))])
    write_dump(d, "works", [line("/type/work", f"/works/OL{k}W", text) for k, text in enumerate(lines)])
    write_dump(d, "authors", [author("OL1A", name="One"), author("OL2A", name="Two"), line("/type/author", "/authors/OL3A", '{"name":"a","name":"b"}')])
    setting = spark.conf.get("spark.sql.variant.allowDuplicateKeys")
    report = run_import(spark, d, root, run_ts=T1)
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == setting
    store = TableStore(spark, root)
    assert _rows(store, "works", ["open_library_id", "title", "description"]) == [
        ("OL0W", "A", "y"), ("OL2W", "A", None), ("OL3W", "A", None), ("OL7W", "A", None)]
    assert report.scans["works"] == {"written": 4, "malformed": 7} and report.scans["authors"]["malformed"] == 1
    assert _rows(store, "authors", ["open_library_id", "works_count"]) == [("OL2A", 1)]


def test_first_import_writes_the_new_editions_once(spark):
    import glob

    from quire.operators.schemas import LIVE
    from quire.plans.importer import Importer
    from quire.sources.dumps import scan_dump

    d, root, scratch = _dir("dumps"), _dir("store"), _dir("scratch")
    _catalogue(d)
    rows = {k: scan_dump(spark, d, k) for k in ("editions", "works", "authors")}
    written = []
    for run in (T1, T2):
        Importer(spark, TableStore(spark, root), rows, run, scratch=f"{scratch}/{run:%Y%m%d%H%M%S%f}").run(keep_staging=True)
        written.append(bool(glob.glob(f"{scratch}/{run:%Y%m%d%H%M%S%f}/insert_editions/new/*.parquet")))
    assert written == [False, True]
    assert TableStore(spark, root, LIVE).read("editions").count() > 0
