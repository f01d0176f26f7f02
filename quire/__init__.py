"""quire: build and refresh a relational book catalogue from large record dumps with Spark.

Every operator is a DataFrame -> DataFrame (or Column -> Column) function; key and
column names are parameters, so the same code runs on catalogue dumps and on any
other table that plays their role.

Sub-packages:
    functions   lenient JSON readers and text helpers (native Column expressions)
    sources     dump discovery/scan and the versioned Parquet table store
    operators   staging projections, filters, dedup, ranking, merge, counters, checks
    plans       the import modes composed from the operators
"""

from quire.session import get_session, scratch_dir  # noqa: F401

__all__ = ["get_session", "scratch_dir"]
