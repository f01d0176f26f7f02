"""Merge staged rows into live tables: dedup, refresh, slugged insert, upsert (G1-G3,
B1, B4-B8, W1, M1-M8).

Live tables are immutable snapshots, so a merge produces the next snapshot:
``refreshed existing rows  UNION  inserted rows``.  Rows whose natural key is NULL
(created elsewhere) never match and pass through untouched; they are split off
before any join so they cannot pile up in one join partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quire.functions.text import compose_slug, run_timestamp, split_slug
from quire.operators.joins import hot_keys, lookup_join
from quire.operators.rank import assign_ids, max_id, rank_within_groups
from quire.operators.schemas import COUNTERS, DEDUP_ORDER
from quire.session import scratch_dir
from quire.sources.tables import materialize  # noqa: F401  (re-exported for the import modes)

KEY = "open_library_id"


def latest_per_key(df: DataFrame, key: str | list[str] = KEY, order_cols=DEDUP_ORDER,
                   columns: list[str] | None = None) -> DataFrame:
    """G1: one row per key -- the one with the highest ``order_cols``.

    An aggregate rather than a window: duplicates collapse map-side before the
    shuffle, so a key repeated across a large share of the input cannot overload
    one task.  With ``columns`` only those of them that ``df`` has are kept beside the key, so that what
    just chooses the row is not carried twice.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and (columns is None or c in columns)]
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.struct(*order_cols)).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]))


def new_rows(staged: DataFrame, live: DataFrame, key: str = KEY, admit: DataFrame | None = None) -> DataFrame:
    """B1 (+ B2/B3): staged rows whose key is not live, optionally only admitted keys."""
    out = staged.join(live.where(F.col(key).isNotNull()).select(key), key, "left_anti")
    if admit is not None:
        # Distinct first: a popular key collapses map-side instead of piling up in one task.
        out = out.join(admit.select(F.col(admit.columns[0]).alias(key)).distinct(), key, "left_semi")
    return out


def taken_suffixes(live: DataFrame, slug_col: str = "slug", base_col: str = "base_slug",
                   bases: DataFrame | None = None) -> DataFrame:
    """B6 + G3: highest suffix already used per base slug (a plain ``base`` counts 1), of ``bases`` only if
    given.

    The OR-of-equality-and-prefix lookup is rewritten as an equi-key: a live slug ``x--N`` stands for
    base ``x`` with N, and, as any other, for itself with 1 (natural slugs never contain ``--``, but one made
    of a key may).
    """
    base, n = split_slug(F.col(slug_col))
    plain = F.struct(F.col(slug_col).alias("b"), F.lit(1).cast("bigint").alias("n"))
    pairs = F.when(base == F.col(slug_col), F.array(plain)).otherwise(F.array(plain, F.struct(base.alias("b"), n.alias("n"))))
    used = live.select(F.explode(pairs).alias("u")).select(F.col("u.b").alias(base_col), F.col("u.n").alias("n"))
    if bases is not None:
        used = used.join(bases.select(base_col).distinct(), base_col, "left_semi")     # G2
    return used.groupBy(base_col).agg(F.max("n").alias("taken"))


def assign_slugs(rows: DataFrame, key: str = KEY, base_col: str = "base_slug",
                 taken: DataFrame | None = None, out: str = "slug",
                 path: str | None = None) -> DataFrame:
    """W1 + B7 + C9: number rows per base slug in key order, offset by suffixes taken."""
    ranked = rank_within_groups(rows, base_col, key, out="_n", start=taken, path=path)
    return ranked.select(*rows.columns, compose_slug(F.col(base_col), F.col("_n")).alias(out))


@dataclass
class ForeignKey:
    """Resolve ``child_col`` (a natural key) to ``out_col`` (the parent's id)."""
    child_col: str
    parent: DataFrame
    out_col: str
    parent_key: str = KEY
    parent_id: str = "id"

    def ids(self) -> DataFrame:
        return (self.parent.where(F.col(self.parent_key).isNotNull())
                .select(F.col(self.parent_key).alias(self.child_col), F.col(self.parent_id).alias(self.out_col)))

    def resolve(self, df: DataFrame, how: str = "inner", hot_from: DataFrame | None = None) -> DataFrame:
        """Add ``out_col``; with ``inner`` rows whose parent is unknown drop out.

        Parents with a large share of the children are joined by broadcast; they are
        found on ``hot_from`` (a written input with the same keys) when given.
        """
        hot = hot_keys(hot_from, self.child_col) if hot_from is not None else None
        return lookup_join(df, self.ids(), self.child_col, how, hot=hot)


def merged_columns(columns: list[str], fk: ForeignKey | None) -> list[str]:
    """What a merge takes from staged rows beside the key."""
    return [*columns] + ([fk.child_col] if fk is not None else [])


def refresh(live: DataFrame, staged: DataFrame, columns: list[str], run_ts, key: str = KEY,
            fk: ForeignKey | None = None, observation: Observation | None = None,
            deduplicated: bool = False) -> DataFrame:
    """M1-M3 (B8, M8): overwrite ``columns`` of live rows that have a staged row.

    NULLs overwrite too; ``updated_at`` is bumped on every match; id, slug,
    created_at and counters are kept; live rows without a staged row are kept.  With
    ``fk``, a staged row whose parent is unknown updates nothing (the parent is
    resolved on the narrow ``(key, fk)`` columns, then joined back on the unique key).
    ``deduplicated`` skips G1 when the caller already kept one row per key.
    """
    s = staged if deduplicated else latest_per_key(staged, key, columns=merged_columns(columns, fk))
    if fk is not None:
        if not deduplicated:
            s = materialize(s)      # written once: hot parents, the lookup and the join back read it
        narrow = s.select(key, fk.child_col)
        resolved = fk.resolve(narrow, hot_from=narrow).select(key, fk.out_col)
        s = s.join(resolved, key)
    s = s.select(key, *[F.col(c).alias(f"_s_{c}") for c in columns], F.lit(True).alias("_hit"))
    keyed = live.where(F.col(key).isNotNull())
    unkeyed = live.where(F.col(key).isNull())
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    joined = keyed.join(s, key, "left")
    if observation is not None:
        joined = joined.observe(observation, F.sum(hit.cast("long")).alias("updated"))
    ts = run_timestamp(run_ts)
    out = []
    for c in live.columns:
        if c in columns:
            out.append(F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).cast(live.schema[c].dataType).alias(c))
        elif c == "updated_at":
            out.append(F.when(hit, ts).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out).unionByName(unkeyed)


def slugged_insert(staged: DataFrame, live: DataFrame, columns: list[str], run_ts, table: str,
                   key: str = KEY, admit: DataFrame | None = None, fk: ForeignKey | None = None,
                   scratch: str | None = None, deduplicated: bool = False, whole: DataFrame | None = None,
                   all_new: bool = False) -> DataFrame:
    """M4: insert new rows with fresh ids and deduplicated slugs.

    G1 -> B1 (+ admission) -> W1 over *all* new rows, offset by the suffixes already
    taken (B6/B7) -> FK join (an edition dropped there still used up its slug
    number) -> C9 slug -> M6 ids after the live maximum; created_at = updated_at =
    run_ts; counters start at 0.  The new rows are written once; only the narrow
    ``(key, base_slug[, fk])`` columns go through numbering and id assignment, and
    the wide rows are joined back once on the unique key.  ``live`` may be the part of the live table that
    can hold the staged keys; ``whole`` is then all of it, of which slugs and ids are read.  With ``all_new`` the
    caller has written the deduplicated rows and knows that none of them is live: they are not written again.
    """
    whole = live if whole is None else whole
    spark = staged.sparkSession
    scratch = scratch or scratch_dir(spark, f"insert-{table}")
    # Dedup before the anti/semi joins (same result): repeated keys collapse map-side.
    deduped = staged if deduplicated else latest_per_key(staged, key, columns=["base_slug", *merged_columns(columns, fk)])
    new = deduped if all_new and admit is None else materialize(new_rows(deduped, live, key, admit), f"{scratch}/new")
    narrow_cols = [key, "base_slug"] + ([fk.child_col] if fk is not None else [])
    slugged = assign_slugs(new.select(*narrow_cols), key, "base_slug", taken_suffixes(whole, bases=new.select("base_slug")),
                           path=f"{scratch}/numbered")
    if fk is not None:
        slugged = fk.resolve(slugged, hot_from=new.select(fk.child_col))
    # Written once: numbering ids reads them twice.
    slugged = materialize(slugged, f"{scratch}/slugged")
    ids = assign_ids(slugged, key, max_id(whole))
    extra = [fk.out_col] if fk is not None else []
    rows = new.join(ids.select(key, "slug", "id", *extra), key)
    ts = run_timestamp(run_ts)
    out = []
    for f in live.schema.fields:
        c = f.name
        if c in ("created_at", "updated_at"):
            out.append(ts.alias(c))
        elif c == COUNTERS.get(table):
            out.append(F.lit(0).alias(c))
        elif c in rows.columns and (c in columns or c in (key, "id", "slug") or c in extra):
            out.append(F.col(c).cast(f.dataType).alias(c))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(c))
    return rows.select(*out)


def authorship_links(refs: DataFrame, works: DataFrame, authors: DataFrame,
                     path: str | None = None) -> DataFrame:
    """B5 + G4: ``(work_id, author_id, position)`` with the minimum position per pair.

    The minimum is taken on the natural keys first (map-side partial aggregation,
    fewer rows into the joins); since natural keys map one-to-one to ids this equals
    grouping by ids.  Refs whose work or author is not live drop out.
    """
    pre = materialize(refs.groupBy("work_olid", "author_olid").agg(F.min("position").alias("position")), path)
    with_work = ForeignKey("work_olid", works, "work_id").resolve(pre, hot_from=pre)
    with_both = ForeignKey("author_olid", authors, "author_id").resolve(with_work, hot_from=pre)
    return with_both.select("work_id", "author_id", "position")


def upsert_authorships(live: DataFrame, links: DataFrame, run_ts,
                       observation: Observation | None = None, whole: DataFrame | None = None) -> DataFrame:
    """M5: insert new ``(work_id, author_id)`` links; for existing ones set position and
    updated_at, keeping id and created_at; links missing from the dump are kept.  ``live`` may be the part of the
    table that can hold the links, ``whole`` is then all of it."""
    keys = ["work_id", "author_id"]
    ts = run_timestamp(run_ts)
    hits = links.select(*keys, F.col("position").alias("_p"), F.lit(True).alias("_hit"))
    joined = live.join(hits, keys, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if observation is not None:
        joined = joined.observe(observation, F.sum(hit.cast("long")).alias("updated"))
    updated = joined.select(*[
        F.when(hit, ts).otherwise(F.col(c)).alias(c) if c == "updated_at"
        else F.when(hit, F.col("_p")).otherwise(F.col(c)).alias(c) if c == "position"
        else F.col(c) for c in live.columns])
    fresh = links.join(live.select(*keys), keys, "left_anti")
    fresh = assign_ids(fresh, keys, max_id(live if whole is None else whole)).select(
        ts.alias("created_at"), ts.alias("updated_at"), "id", "author_id", "work_id", "position")
    return updated.unionByName(fresh)


def child_counts(child: DataFrame, fk: str) -> DataFrame:
    """Rows per parent id (partial aggregation before the shuffle)."""
    return child.groupBy(fk).agg(F.count(F.lit(1)).cast("int").alias("_n"))


def recount(parent: DataFrame, child: DataFrame | None, fk: str, counter: str, parent_id: str = "id",
            counts: DataFrame | None = None) -> DataFrame:
    """M9/M10 (G5 + B9): counter = number of children; childless -> 0; updated_at kept.  ``counts`` are
    children counted already (``child_counts``)."""
    counts = (child_counts(child, fk) if counts is None else counts).withColumnRenamed(fk, parent_id)
    joined = parent.join(counts, parent_id, "left")
    return joined.select(*[F.coalesce(F.col("_n"), F.lit(0)).alias(c) if c == counter else F.col(c)
                           for c in parent.columns])


def wrong_counts(parent: DataFrame, counts: DataFrame, fk: str, counter: str, parent_id: str = "id") -> DataFrame:
    """The parents whose counter is not the number of their children."""
    joined = parent.join(counts.withColumnRenamed(fk, parent_id), parent_id, "left")
    return joined.where(~F.coalesce(F.col("_n"), F.lit(0)).eqNullSafe(F.col(counter))).drop("_n")
