"""Schemas of the live tables (the target contract) and of the staged rows."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S, I, L, TS = StringType(), IntegerType(), LongType(), TimestampNTZType()


def _schema(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


AUTHORS = _schema(
    ("created_at", TS, False), ("updated_at", TS, False), ("id", L, False), ("open_library_id", S, True),
    ("works_count", I, False), ("name", S, False), ("bio", S, True), ("sort_name", S, True),
    ("birth_date", S, True), ("death_date", S, True), ("photo_id", S, True), ("slug", S, False),
)
WORKS = _schema(
    ("created_at", TS, False), ("updated_at", TS, False), ("id", L, False), ("open_library_id", S, True),
    ("edition_count", I, False), ("title", S, False), ("subtitle", S, True), ("description", S, True),
    ("cover_id", S, True), ("first_publish_date", S, True), ("first_publish_year", I, True),
    ("subjects", ArrayType(S, True), False), ("slug", S, False),
)
AUTHORSHIPS = _schema(
    ("created_at", TS, False), ("updated_at", TS, False), ("id", L, False), ("author_id", L, False),
    ("work_id", L, False), ("position", I, False),
)
EDITIONS = _schema(
    ("created_at", TS, False), ("updated_at", TS, False), ("id", L, False), ("open_library_id", S, True),
    ("work_id", L, False), ("google_books_id", S, True), ("goodreads_id", S, True), ("asin", S, True),
    ("title", S, True), ("cover_id", S, True), ("format", S, True), ("isbn10", S, True), ("isbn13", S, True),
    ("language", S, True), ("page_count", I, True), ("published_year", I, True), ("publisher", S, True),
    ("subtitle", S, True), ("series", S, True), ("edition_name", S, True), ("internet_archive_id", S, True),
    ("slug", S, False),
)
LIVE = {"authors": AUTHORS, "works": WORKS, "authorships": AUTHORSHIPS, "editions": EDITIONS}

# What the tables are kept in buckets by: the natural key, or the id of rows without one.
BUCKET_KEYS = {"authors": ["open_library_id", "id"], "works": ["open_library_id", "id"],
               "editions": ["open_library_id", "id"], "authorships": ["work_id"]}

# Columns a refresh overwrites (NULLs overwrite too); id, slug, created_at and the
# counters are never touched by a refresh.
REFRESH_COLUMNS = {
    "authors": ["name", "bio", "birth_date", "death_date", "photo_id"],
    "works": ["title", "subtitle", "description", "first_publish_date", "first_publish_year", "cover_id",
              "subjects"],
    "editions": ["title", "subtitle", "asin", "cover_id", "format", "goodreads_id", "google_books_id", "isbn10",
                 "isbn13", "language", "page_count", "published_year", "publisher", "series", "edition_name",
                 "internet_archive_id", "work_id"],
}
COUNTERS = {"authors": "works_count", "works": "edition_count"}

# Staged rows: the typed projection of one dump line, plus the columns that pin
# which duplicate wins (revision, last_modified, rec_hash) and the file position.
DEDUP_ORDER = ["revision", "last_modified", "rec_hash"]
STAGED_AUTHORS = ["open_library_id", "base_slug", "name", "bio", "birth_date", "death_date", "photo_id"]
STAGED_WORKS = ["open_library_id", "base_slug", "title", "subtitle", "description", "first_publish_date",
                "first_publish_year", "cover_id", "subjects"]
STAGED_EDITIONS = ["work_olid", "open_library_id", "base_slug", "title", "subtitle", "asin", "cover_id", "format",
                   "goodreads_id", "google_books_id", "isbn10", "isbn13", "language", "page_count",
                   "published_year", "publisher", "series", "edition_name", "internet_archive_id"]
STAGED_REFS = ["work_olid", "author_olid", "position"]
