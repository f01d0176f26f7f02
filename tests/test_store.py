"""One commit for all tables of a run (S7), and integrity rules once per written version."""

import os
import shutil

import pytest

from quire.operators import checks
from quire.operators import merge as M
from quire.operators.schemas import BUCKET_KEYS, LIVE
from quire.plans.importer import Importer, run_import
from quire.sources.store import CommitConflict, TableStore
from dumps import author, edition, work, write_dump
from test_import import T1, T2, _catalogue, _dir, _rows

KEY = {"authors": "open_library_id", "works": "open_library_id", "editions": "open_library_id", "authorships": "id"}


def _state(store):
    return {t: _rows(store, t, [KEY[t], "updated_at"]) for t in LIVE}


def _folders(store):
    return {t: store._versions(t, committed_only=False) for t in LIVE}


def _break(monkeypatch, at):
    """Make a run fail when it comes to a table."""
    merge = Importer.merge

    def failing(self, table, *args, **kw):
        if table == at:
            raise RuntimeError("killed")
        return merge(self, table, *args, **kw)
    monkeypatch.setattr(Importer, "merge", failing)


@pytest.fixture(scope="module")
def imported(spark, tmp_path_factory):
    """A folder of dumps, and a store after their import with the tables that were checked."""
    d, root = _dir("dumps"), _dir("store")
    _catalogue(d)
    calls, check = [], checks.check
    checks.check = lambda tables, changed=None: (calls.append(set(changed)), check(tables, changed))
    try:
        run_import(spark, d, root, run_ts=T1)
    finally:
        checks.check = check
    return d, root, calls


def _copy(spark, imported):
    root = _dir("copy") + "/store"
    shutil.copytree(imported[1], root)
    return imported[0], root, TableStore(spark, root, dict(LIVE))


def test_a_first_run_killed_leaves_nothing(spark, monkeypatch):
    d, root = _dir("dumps"), _dir("store")
    _catalogue(d)
    _break(monkeypatch, "authors")
    with pytest.raises(RuntimeError, match="killed"):
        run_import(spark, d, root, run_ts=T1)
    store = TableStore(spark, root, dict(LIVE))
    assert store.catalogues() == [] and all(store.version(t) is None for t in LIVE) and not any(_folders(store).values())


def test_a_run_killed_between_tables_changes_none(spark, monkeypatch, imported):
    d, root, store = _copy(spark, imported)
    before, folders, catalogue = _state(store), _folders(store), store.catalogue()
    assert set(catalogue[1]) == set(LIVE)
    _break(monkeypatch, "editions")
    with pytest.raises(RuntimeError, match="killed"):
        run_import(spark, d, root, run_ts=T2)
    assert (_state(store), _folders(store), store.catalogue()) == (before, folders, catalogue)


def test_a_failing_foreign_key_leaves_all_tables_at_the_old_version(spark, monkeypatch, imported):
    d, root, store = _copy(spark, imported)
    before, catalogue = _state(store), store.catalogue()
    links = M.authorship_links

    def orphaned(*args, **kw):
        return links(*args, **kw).withColumn("author_id", M.F.col("author_id") + 1000)
    monkeypatch.setattr(M, "authorship_links", orphaned)
    with pytest.raises(checks.IntegrityError, match="foreign_key:author_id"):
        run_import(spark, d, root, only="works", run_ts=T2)
    assert (_state(store), store.catalogue()) == (before, catalogue)
    monkeypatch.undo()
    run_import(spark, d, root, only="works", run_ts=T2)
    assert store.catalogue()[0] == catalogue[0] + 1 and _state(store) != before
    # The older catalogue still names a state of all four tables.
    assert store.catalogue(catalogue[0]) == catalogue


def test_each_written_version_is_checked_once(spark, monkeypatch, imported):
    d, root, store = _copy(spark, imported)
    calls, check = [], checks.check
    monkeypatch.setattr(checks, "check", lambda tables, changed=None: (calls.append(set(changed)), check(tables, changed)))
    run_import(spark, d, root, only="authors", run_ts=T2)
    assert imported[2] == [set(LIVE)] and calls == [{"authors"}]
    rules = lambda changed: {(r.table, r.rule) for r in checks.violations({t: store.read(t) for t in LIVE}, changed).collect()}
    every = rules(None)
    assert {r for r in every if r[0] == "authors"} | {("authorships", "foreign_key:author_id->authors.id")} == rules({"authors"})


def test_tables_become_current_together(spark):
    store = TableStore(spark, _dir("store"))
    one = spark.range(1)
    with store.transaction() as tx:
        tx.write("a", one)
        tx.write("b", one)
        other = TableStore(spark, store.root)
        assert other.version("a") is None and tx.read("a").count() == 1
        tx.write("a", spark.range(2))           # supersedes what the run wrote before
        assert tx.read("a").count() == 2
    assert other.catalogue() == (1, {"a": 3, "b": 2}) and other._versions("a", committed_only=False) == [3]
    assert other.write("b", spark.range(3)) == 4
    assert other.catalogue() == (2, {"a": 3, "b": 4}) and other.read("a").count() == 2
    with pytest.raises(RuntimeError), store.transaction(), store.transaction():
        pass
    assert store.catalogue()[0] == 2


def test_of_two_runs_at_once_the_later_one_fails(spark):
    first, second = (TableStore(spark, root) for root in [_dir("store")] * 2)
    with pytest.raises(CommitConflict):
        with first.transaction():
            first.write("a", spark.range(1))
            second.write("b", spark.range(5))
    assert second.catalogue() == (1, {"b": 2}) and second._versions("a", committed_only=False) == []
    first.write("a", spark.range(1))
    assert first.catalogue() == (2, {"a": 3, "b": 2})


def test_a_check_sees_what_was_written_and_can_refuse_it(spark):
    store, seen = TableStore(spark, _dir("store")), []

    def check(tables):
        seen.append({t: df.count() for t, df in tables.items()})
        raise ValueError("no")
    with pytest.raises(ValueError), store.transaction(check):
        store.write("a", spark.range(1))
        store.write("a", spark.range(4))
    assert seen == [{"a": 4}] and store.version("a") is None
    with store.transaction(check):
        pass                                    # nothing written: nothing to check or commit
    assert len(seen) == 1 and store.catalogues() == []


def test_a_store_from_before_catalogues_is_read(spark):
    root = _dir("store")
    for n in (1, 2, 3):
        spark.range(n).write.parquet(f"{root}/a/v={n}")
    for n in (1, 2):
        open(os.path.join(root, "a", f"v={n}", "_COMMITTED"), "w").close()
    store = TableStore(spark, root)
    assert store.version("a") == 2 and store.read("a").count() == 2
    store.write("b", spark.range(1))
    assert store.catalogue() == (1, {"a": 2, "b": 4}) and store.write("a", spark.range(9)) == 5


def test_keys_with_the_separator_are_imported(spark):
    """A base slug made of such a key holds ``--``; it takes part in numbering as itself and as a suffix."""
    live = spark.createDataFrame([("ol--1w",), ("x--5",), ("x",), ("y",)], "slug string")
    got = {(r.base_slug, r.taken) for r in M.taken_suffixes(live).collect()}
    assert got == {("ol--1w", 1), ("x", 5), ("x--5", 1), ("y", 1)}
    some = M.taken_suffixes(live, bases=spark.createDataFrame([("x",), ("x",), ("z",)], "base_slug string"))
    assert [tuple(r) for r in some.collect()] == [("x", 5)]


def test_a_refresh_of_one_row_writes_one_bucket(spark):
    d, root = _dir("dumps"), _dir("store")
    names = [f"OL{k}W" for k in range(1, 61)]
    write_dump(d, "editions", [edition(f"OL{k}M", title="E", works=[{"key": f"/works/OL{k}W"}], languages=[{"key": "/languages/eng"}])
                               for k in range(1, 61)])
    write_dump(d, "works", [work(n, title="T " + n) for n in names])
    write_dump(d, "authors", [author("OL1A", name="A")])
    run_import(spark, d, root, run_ts=T1)
    store = TableStore(spark, root, dict(LIVE), dict(BUCKET_KEYS))
    number, before = store.catalogue()
    rows = {r.open_library_id: r for r in store.read("works").collect()}
    assert len(rows) == 60 and {r.edition_count for r in rows.values()} == {1}
    write_dump(d, "works", [work("OL7W", title="new")], name="2")
    os.utime(os.path.join(d, "ol_dump_works_2.txt.gz"), (2 ** 31 - 9, 2 ** 31 - 9))
    report = run_import(spark, d, root, only="works", run_ts=T2)
    _, after = store.catalogue()
    changed = [b for b, (x, y) in enumerate(zip(before["works"], after["works"])) if x != y]
    own = spark.createDataFrame([("OL7W", None)], "open_library_id string, id long")
    assert changed == store.touched("works", own) and len(changed) == 1
    assert os.listdir(f"{root}/works/v={after['works'][changed[0]]}") .count(f"bucket={changed[0]}") == 1
    assert len([x for x in os.listdir(f"{root}/works/v={after['works'][changed[0]]}") if x.startswith("bucket=")]) == 1
    assert {t: after[t] for t in ("authors", "editions")} == {t: before[t] for t in ("authors", "editions")}
    now = {r.open_library_id: r for r in store.read("works").collect()}
    assert {k for k in rows if rows[k] != now[k]} == {"OL7W"} and now["OL7W"].title == "new" and now["OL7W"].slug == rows["OL7W"].slug
    assert report.merges["works"] == {"updated": 1, "inserted": 0}
    # Counters: a wrong one has its bucket rewritten, right ones have not.
    live = store.read("works")
    store.write("works", live.withColumn("edition_count", M.F.when(M.F.col("open_library_id") == "OL9W", 5).otherwise(M.F.col("edition_count"))))
    _, seeded = store.catalogue()
    imp = Importer(spark, store, {}, run_ts=T2)
    with store.transaction():
        imp.recount_editions()
    _, fixed = store.catalogue()
    own = spark.createDataFrame([("OL9W", None)], "open_library_id string, id long")
    assert [b for b, (x, y) in enumerate(zip(seeded["works"], fixed["works"])) if x != y] == store.touched("works", own)
    assert {r.edition_count for r in store.read("works").collect()} == {1}
    with store.transaction():
        Importer(spark, store, {}, run_ts=T2).recount_editions()
    assert store.catalogue()[1] == fixed      # nothing wrong, nothing written
    gone = store.vacuum("works", keep=1)
    assert gone and {r.open_library_id for r in store.read("works").collect()} == set(names)


def test_rows_without_a_key_have_a_bucket_and_wrong_buckets_are_refused(spark):
    store = TableStore(spark, _dir("store"), keys={"t": ["k", "id"]}, buckets=4)
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 4), (None, None), ("c", 5)], "k string, id long")
    store.write("t", rows)
    assert sorted(map(str, store.read("t").collect())) == sorted(map(str, rows.collect()))
    place = store.place("t")
    some = store.touched("t", rows.where("k = 'a'"))
    assert len(some) == 1 and store.read("t", some).where("k = 'a'").count() == 1
    assert store.read("t", some).count() < 6
    store.write("t", store.read("t", some).where("k <> 'a' OR k IS NULL"), only=some)
    assert store.read("t").count() == 5 and [b for b in range(4) if store.place("t")[b] != place[b]] == some
    with pytest.raises(ValueError, match="other buckets"):
        store.write("t", rows, only=some)
    assert store.read("t").count() == 5
    # All rows of a bucket may go.
    store.write("t", rows.where("false"), only=some)
    assert store.place("t")[some[0]] == 0 and store.read("t").count() <= 5
