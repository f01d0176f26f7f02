"""Driver contract: entry smoke run, query/oracle keys, and a few oracle comparisons."""

import duckdb

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


def _norm(v):
    import pandas as pd
    if v is None or (not isinstance(v, (list, tuple)) and pd.isna(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return int(v) if isinstance(v, float) and v.is_integer() else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(v) for v in rec) for rec in pdf[cols].itertuples(index=False)), key=repr)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["tbl", "key", "ref", "slug", "name", "n"]


def test_every_query_has_an_oracle():
    from quire.plans import registry
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_some_oracles_at_small_scale(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ["lenient_scalars", "stage_authors", "stage_works", "slugged_insert", "integrity"]:
        got = _rows(E.queries()[name](spark, SF).toPandas())
        want = _rows(con.execute(E.oracle_sql()[name]).fetchdf())
        assert got == want, name
