"""Secret scans with multipart credential linking.

Three patterns are reported wherever they match (the base spans): assignments of long values to
names of secrets, access key ids, and long hexadecimal runs.  Other parts of a credential are too
common to be reported alone: identifiers (user names, client and short key ids), weak secrets (short
passwords, keys, mixed tokens) and endpoints (addresses of machines and services).  They count only
together: Spark joins the intervals of secrets, widened by ``REACH`` code points, with
those of identifiers and endpoints in the same scope (a paragraph: text between blank lines), and a
weak part is reported when a complementary one, weak or base, is met.

The interval join meets in bins of ``BIN`` code points: a part stands in every bin it touches, a
secret also in those within its reach.  A bin holds few parts, whatever a text's length, and texts that many
rows share are joined once.

Defined cases: a null text reads as empty, empty texts have no spans; texts of any length
are scanned whole; a part that overlaps a base span is that span's (it isn't reported again, but counts
as a complement through it); overlapping weak parts are each reported; equal texts get equal
spans; repeated rows and null keys keep their rows; an empty table gives none.  Only the named
columns are read; starts and ends are code points, the end exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import importable, table, written
from quire.operators.joins import lookup_join

REACH = 160
BIN = 256
HOT_ROWS = 10_000     # rows of one text from which its join is split off

#: Kinds in the order that spans of one start are listed in.
ASSIGN, ACCESS, HEX, IDENTIFIER, SECRET, ENDPOINT = range(6)
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
SECRETS, PARTNERS = (ASSIGN, HEX, SECRET), (ACCESS, IDENTIFIER, ENDPOINT)

# Base patterns (fixed values) and the least lengths of what they match.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")       # 18 characters; a shorter run holds no longer one
_HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE = 12

# Weak parts.
_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
_WEAK = (
    (IDENTIFIER, re.compile(r"(?<![A-Za-z0-9])(?:user(?:_?name)?|login|account|client_?id|uid|access_?key(?:_?id)?)"
                            + _GIVEN + r"[A-Za-z0-9][A-Za-z0-9@+/_.-]{2,}", re.I | re.A), "=:"),
    (SECRET, re.compile(r"(?<![A-Za-z0-9])(?:pass|pwd|pin|auth|credentials?|signature|(?:private|secret|account)_?key)"
                        + _GIVEN + r"[!#-&(-~]{4,}", re.I | re.A), "=:"),
    (ENDPOINT, re.compile(r"(?<![A-Za-z0-9])(?:host(?:name)?|server|endpoint|database|db|url)" + _GIVEN
                          + r"[A-Za-z0-9][A-Za-z0-9:/_.-]{2,}", re.I | re.A), "=:"),
    (ENDPOINT, re.compile(r"(?<![A-Za-z0-9])[a-z][a-z0-9+.-]{1,9}://[^\s\"'<>]{3,}", re.A), "://"),
    (ENDPOINT, re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?(?![0-9]|\.[0-9])"), "."),
    (IDENTIFIER, re.compile(r"(?<![A-Z0-9])(?:AKIA|ASIA|AROA|AIDA)[A-Z0-9]{6,}"), "A"),
    (SECRET, re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"), ""),
)
_MIXED = (re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]"))
_BLANK_LINE = re.compile(r"\n[ \t\r]*\n")

Span = tuple[int, int, int]     # start, kind, end


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans of a text in order, and assignments whose value is too short for one."""
    found, short = [], []
    for m in _ASSIGN.finditer(text):
        (found if m.end() - m.start(2) >= LEAST_VALUE else short).append((m.start(), ASSIGN, m.end()))
    found += [(m.start(), ACCESS, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), HEX, m.end()) for m in _HEX.finditer(text)]
    return sorted(found), short


def weak_parts(text: str, base: list[Span], short: list[Span]) -> list[Span]:
    """The weak parts of a text that overlap no base span."""
    parts = {(a, SECRET, b) for a, _, b in short if b - a >= 8}
    for kind, pattern, needs in _WEAK:
        if needs and not any(c in text for c in ((needs,) if needs == "://" else needs)):
            continue
        for m in pattern.finditer(text):
            if needs or all(p.search(m[0]) for p in _MIXED):
                parts.add((m.start(), kind, m.end()))
    starts, ends, last = [a for a, _, _ in base], [], 0
    for _, _, b in base:
        last = max(last, b)
        ends.append(last)

    def free(a: int, b: int) -> bool:
        k = bisect.bisect_left(starts, b)
        return not k or ends[k - 1] <= a

    return sorted(p for p in parts if free(p[0], p[2]))


def scan(text: str) -> tuple[list[Span], list[tuple[int, int, int, int]], bytes | None]:
    """Base spans; all parts with their scope (its start), if any of them is weak; and then the
    text's digest."""
    base, short = base_spans(text)
    weak = weak_parts(text, base, short)
    if not weak or not (any(k in SECRETS for _, k, _ in (*base, *weak)) and any(k in PARTNERS for _, k, _ in (*base, *weak))):
        return base, [], None
    cuts = [0, *(m.end() for m in _BLANK_LINE.finditer(text))]
    parts = [(cuts[bisect.bisect_right(cuts, a) - 1], a, k, b) for a, k, b in (*base, *weak)]
    return base, parts, hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_PART = pa.struct([("scope", pa.int32()), ("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_SCAN = pa.struct([("base", pa.list_(_SPAN)), ("parts", pa.list_(_PART)), ("digest", pa.binary())])


def scanned(text: Column) -> Column:
    @F.arrow_udf("struct<base:array<struct<start:int,kind:int,end:int>>,"
                 "parts:array<struct<scope:int,start:int,kind:int,end:int>>,digest:binary>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = []
            for t in batch:
                base, parts, digest = scan(t.as_py() or "")
                found.append({"base": [dict(zip(("start", "kind", "end"), s)) for s in base],
                              "parts": [dict(zip(("scope", "start", "kind", "end"), p)) for p in parts], "digest": digest})
            yield pa.array(found, _SCAN)

    return read(text)


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak ones of distinct parts (digest, scope, start, kind, end) that a complementary part
    is within reach of, in the same scope."""
    def bins(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / BIN), F.floor(high / BIN)))

    secrets = parts.where(F.col("kind").isin(*SECRETS)).select(
        "digest", "scope", "start", "kind", "end", bins(F.col("start") - reach, F.col("end") + reach).alias("bin"))
    partners = parts.where(F.col("kind").isin(*PARTNERS)).select(
        "digest", "scope", *[F.col(c).alias("p_" + c) for c in ("start", "kind", "end")], bins(F.col("start"), F.col("end")).alias("bin"))
    near = (F.col("p_start") <= F.col("end") + reach) & (F.col("start") <= F.col("p_end") + reach)
    pairs = secrets.join(partners, ["digest", "scope", "bin"]).where(near)
    both = F.explode(F.array(*[F.struct(*[F.col(p + c).alias(c) for c in ("start", "kind", "end")]) for p in ("", "p_")]))
    return pairs.select("digest", both.alias("s")).where(F.col("s.kind") >= IDENTIFIER).distinct()


def find_secrets(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, spans) of every row: arrays of (start, kind, end), in order; ``spans`` has the base
    spans and the linked weak parts."""
    importable(df.sparkSession)
    rows = df.select(F.col(key).alias("key"), scanned(F.col(text)).alias("s")).select("key", "s.base", "s.parts", "s.digest")
    rows = written(rows, "scanned")
    parts = rows.where("digest IS NOT NULL").select("digest", F.inline("parts")).distinct()
    more = linked(parts).groupBy("digest").agg(F.collect_list("s").alias("more"))
    more = written(more, "linked")
    with_parts = lookup_join(rows.where("digest IS NOT NULL").select("key", "base", "digest"), more, "digest", "left",
                             min_rows=HOT_ROWS).select("key", "base", F.coalesce("more", F.array()).alias("more"))
    without = rows.where("digest IS NULL").select("key", "base", F.slice("base", 1, 0).alias("more"))
    done = with_parts.unionByName(without)
    return done.select(F.col("key").alias(key), "base", F.array_sort(F.concat("base", "more")).alias("spans"))


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def op11_secrets(spark, sf_dir: str) -> DataFrame:
    rows = find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return rows.select("doc_id", count(ASSIGN).alias("n_assign"), count(ACCESS).alias("n_access"), count(HEX).alias("n_hex"),
                       F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
