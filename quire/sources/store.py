"""Versioned Parquet table store.

Each table lives under ``<root>/<table>/v=<N>/``; nothing written is ever overwritten.  What
is current is told by a catalogue: ``<root>/_catalogue/<M>.json`` names the versions of
every table, and the highest M counts.  It is written under a temporary name and renamed, so all
tables of a run become current at once or none does.  Readers never see what no catalogue
names: a failed run leaves every table as it was.

Tables with a key (``keys``) are kept in buckets by a hash of it (of the next key column where one is null),
``v=<N>/bucket=<B>/``, and the catalogue names a version for each bucket.  A write of some buckets only
leaves the others where they are, so a merge of few rows reads and writes few buckets.  Files within a
bucket are sized by Spark (a rebalance), whatever the bucket's size.

``transaction()`` groups the writes of a run: inside it, the store reads its own uncommitted
versions; at its end ``check`` looks at what was written, and one catalogue is written.  A write
outside is a transaction of its own.  Two runs that commit at the same time do not mix: the later one
finds its number taken and fails.

An absent table reads as an empty DataFrame with the table's schema.  Stores from before there was a
catalogue, whose versions carry a ``_COMMITTED`` marker, are read as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_MARKER = "_COMMITTED"
_CATALOGUE = "_catalogue"
BUCKETS = 16      # of a table with a key, unless told otherwise

#: Where a table is: a version, or one for each bucket (0: the bucket has no rows).
Place = int | list[int]


def _named(place: Place | None) -> set[int]:
    return set() if place is None else {place} if isinstance(place, int) else set(place) - {0}


class CommitConflict(RuntimeError):
    """Another run committed since this one began."""


class TableStore:
    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, StructType] | None = None,
                 keys: dict[str, list[str]] | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = dict(schemas or {})
        self.keys = dict(keys or {})
        self.buckets = buckets
        self._jvm = spark.sparkContext._jvm
        self._Path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._pending: dict[str, Place] | None = None     # written in the open transaction
        self._base: tuple[int, dict[str, Place]] = (0, {})  # the catalogue that it began from

    # -- the catalogue ---------------------------------------------------------
    def catalogues(self) -> list[int]:
        """Numbers of the committed catalogues."""
        folder = self._Path(f"{self.root}/{_CATALOGUE}")
        if not self._fs.exists(folder):
            return []
        names = [st.getPath().getName() for st in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def catalogue(self, number: int | None = None) -> tuple[int, dict[str, Place]]:
        """(number, place of every table) of a catalogue, the current one unless given."""
        numbers = self.catalogues()
        if number is None and not numbers:
            return 0, {t: v[-1] for t in self._tables() if (v := self._versions(t))}
        number = numbers[-1] if number is None else number
        stream = self._fs.open(self._Path(f"{self.root}/{_CATALOGUE}/{number}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return number, json.loads(text)

    def _tables(self) -> list[str]:
        root = self._Path(self.root)
        if not self._fs.exists(root):
            return []
        return [st.getPath().getName() for st in self._fs.listStatus(root)
                if st.isDirectory() and not st.getPath().getName().startswith("_")]

    @contextmanager
    def transaction(self, check: Callable[[dict[str, DataFrame]], None] | None = None) -> Iterator[TableStore]:
        """Everything written inside becomes current together, after ``check`` has passed the written
        tables (by name); an exception, from it or the block, leaves the store as it was."""
        if self._pending is not None:
            raise RuntimeError("a transaction is open already")
        self._base, self._pending = self.catalogue(), {}
        began = {t: set(self._versions(t, committed_only=False)) for t in self._tables()}
        try:
            yield self
            written = dict(self._pending)
            if written:
                if check is not None:
                    check({t: self.read(t) for t in written})
                self._commit({**self._base[1], **written}, self._base[0] + 1)
        finally:
            current, self._pending = self._pending, None
            kept = self.catalogue()[1]
            for table in current:      # versions of this run that nothing names: superseded, or all if it failed
                for v in set(self._versions(table, committed_only=False)) - began.get(table, set()) - _named(kept.get(table)):
                    self._fs.delete(self._Path(f"{self.root}/{table}/v={v}"), True)

    def _commit(self, versions: dict[str, Place], number: int) -> None:
        target = self._Path(f"{self.root}/{_CATALOGUE}/{number}.json")
        draft = self._Path(f"{self.root}/{_CATALOGUE}/_draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps(versions, sort_keys=True).encode()))
        out.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise CommitConflict(f"catalogue {number} of {self.root} was written by another run")

    # -- listing -------------------------------------------------------------
    def _versions(self, table: str, committed_only: bool = True) -> list[int]:
        tdir = self._Path(f"{self.root}/{table}")
        if not self._fs.exists(tdir):
            return []
        catalogues = self.catalogues() if committed_only else []
        out, named = [], set().union(*(_named(self.catalogue(n)[1].get(table)) for n in catalogues))
        for st in self._fs.listStatus(tdir):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("v=") and name[2:].isdigit():
                n = int(name[2:])
                if not committed_only or n in named or self._fs.exists(self._Path(f"{self.root}/{table}/{name}/{_MARKER}")):
                    out.append(n)
        return sorted(out)

    def place(self, table: str) -> Place | None:
        if self._pending is not None:
            return self._pending.get(table, self._base[1].get(table))
        return self.catalogue()[1].get(table)

    def version(self, table: str) -> int | None:
        """The newest version of a table that is current."""
        return max(_named(self.place(table)), default=None)

    def path(self, table: str, version: int | None = None) -> str | None:
        v = self.version(table) if version is None else version
        return None if v is None else f"{self.root}/{table}/v={v}"

    # -- buckets -------------------------------------------------------------
    def bucket(self, table: str, count: int | None = None) -> Column:
        """The bucket of a row, by the table's key; rows need only the key's columns."""
        if count is None:
            place = self.place(table)
            count = len(place) if isinstance(place, list) else self.buckets
        key = F.coalesce(*[F.col(c).cast("string") for c in self.keys[table]])
        return F.pmod(F.hash(key), F.lit(count)).cast("int")

    def touched(self, table: str, keys: DataFrame) -> list[int] | None:
        """The buckets that some keys fall into (at most one row each comes to the driver); None: all, or the table
        has no buckets yet."""
        place = self.place(table)
        if not isinstance(place, list):
            return None
        found = sorted(r[0] for r in keys.select(self.bucket(table)).distinct().collect() if r[0] is not None)
        return found if len(found) < len(place) else None

    # -- read / write --------------------------------------------------------
    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        """A table, or some of its buckets."""
        place, schema, folder = self.place(table), self.schemas.get(table), f"{self.root}/{table}"
        if isinstance(place, list):
            chosen = range(len(place)) if buckets is None else buckets
            if buckets is None and len(set(place)) == 1 and 0 not in place:
                paths = [f"{folder}/v={place[0]}"]
            else:
                paths = [f"{folder}/v={place[b]}/bucket={b}" for b in chosen if place[b]]
        else:
            paths = [] if place is None else [f"{folder}/v={place}"]
        if not paths:
            if schema is None:
                raise KeyError(f"table {table} has no snapshot and no schema")
            return self.spark.createDataFrame([], schema)
        if schema is None:
            df = self.spark.read.parquet(*paths)
            return df.drop("bucket") if isinstance(place, list) else df
        df = self.spark.read.parquet(*paths)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])

    def is_empty(self, table: str) -> bool:
        """Whole-table emptiness test (reads at most one row)."""
        return self.path(table) is None or self.read(table).limit(1).isEmpty()

    def write(self, table: str, df: DataFrame, check: Callable[[DataFrame], None] | None = None,
              only: list[int] | None = None) -> int:
        """Write a new version; it becomes current with its transaction, or at once after ``check`` outside of one.
        With ``only``, the rows are those of some buckets, and the other buckets stay as they are."""
        if self._pending is None:
            with self.transaction(None if check is None else lambda tables: check(tables[table])):
                return self.write(table, df, only=only)
        place = self.place(table)
        # Numbered over the whole store: a higher number was written later, in whatever table.
        n = max((v for t in {table, *self._tables()} for v in self._versions(t, committed_only=False)), default=0) + 1
        schema, folder = self.schemas.get(table), f"{self.root}/{table}/v={n}"
        if schema is not None:
            df = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
        if table in self.keys:
            count = len(place) if isinstance(place, list) and only is not None else self.buckets
            df = df.withColumn("bucket", self.bucket(table, count)).hint("rebalance", F.col("bucket"))
            df.write.mode("errorifexists").partitionBy("bucket").parquet(folder)
            names = [st.getPath().getName() for st in self._fs.listStatus(self._Path(folder)) if st.isDirectory()]
            filled = {int(x[7:]) for x in names if x.startswith("bucket=")}
            kept = [0] * count if only is None else [0 if b in set(only) else v for b, v in enumerate(place)]
            if filled - set(range(count) if only is None else only):
                raise ValueError(f"{table}: rows of other buckets than those being written")
            self._pending[table] = [n if b in filled else v for b, v in enumerate(kept)]
        else:
            df.write.mode("errorifexists").parquet(folder)
            self._pending[table] = n
        if check is not None:
            check(self.read(table))
        return n

    def vacuum(self, table: str, keep: int = 2) -> list[int]:
        """Delete the versions of a table that its newest ``keep`` committed states do not use (and any
        uncommitted one older than those).  Run it when no reader still uses old snapshots."""
        numbers, states = self.catalogues(), []
        for number in reversed(numbers):
            place = self.catalogue(number)[1].get(table)
            if place is not None and (not states or states[-1][1] != place):
                states.append((number, place))
        if not numbers:
            states = [(0, v) for v in reversed(self._versions(table))]
        if len(states) <= keep:
            return []
        used = set().union(*(_named(place) for _, place in states[:keep]))
        gone = [v for v in self._versions(table, committed_only=False) if v not in used and v < max(used)]
        for v in gone:
            self._fs.delete(self._Path(f"{self.root}/{table}/v={v}"), True)
        for number in numbers[:-1]:     # those that name what is gone
            if _named(self.catalogue(number)[1].get(table)) & set(gone):
                self._fs.delete(self._Path(f"{self.root}/{_CATALOGUE}/{number}.json"), False)
        return gone


def delete_tree(spark: SparkSession, path: str) -> None:
    """Remove a folder (e.g. a finished run's staging area) on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)
