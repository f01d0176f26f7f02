"""Lenient JSON readers: every reader accepts any JSON value and extracts what it can.

A record's JSON text is parsed once into a ``VARIANT``; each reader is a native
Column -> Column expression over that variant (no Python UDF).  Readers of whole arrays
use lambdas, which run outside whole-stage codegen.

Type tests use ``schema_of_variant``: integers parse as ``BIGINT``; numbers with a
fraction or a trailing ``.0`` parse as ``DECIMAL(p,s)`` (``1.0`` as ``DECIMAL(1,0)``);
exponent forms as ``DOUBLE``.
A plain cast would turn ``true`` into ``'true'`` and objects into JSON text, so each
reader checks the type first.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values ---------------------------------------------------------------
# Characters with the Unicode White_Space property, in code point order:
# U+0009..U+000D, U+0020, U+0085, U+00A0, U+1680, U+2000..U+200A, U+2028, U+2029,
# U+202F, U+205F, U+3000.  Leading/trailing runs of these are trimmed from strings.
UNICODE_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Appended after the record when it is wrapped in a JSON array for the strict parse.
_SENTINEL = "~end-of-record~"
# Levels of nesting that the JSON parser accepts.
MAX_NESTING = 1000
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Trim Unicode whitespace from both ends (``trim`` alone strips only U+0020)."""
    return F.trim(_col(c), F.lit(UNICODE_WHITESPACE))


def wrap_record(json_text) -> Column:
    """``[<record>, "<sentinel>"]`` parsed once; see ``record_of``."""
    return F.try_parse_json(F.concat(F.lit("["), _col(json_text), F.lit(f',"{_SENTINEL}"]')))


def starts_object(json_text) -> Column:
    """Whether a JSON text begins as an object does; with ``record_of`` this spares a look at the type of the whole
    record, whose schema Spark would have to spell out."""
    return F.ltrim(_col(json_text), F.lit(" \t\n\r")).startswith("{")


def record_of(wrapped, object_known: bool = False) -> Column:
    """The record object from a wrapped parse, or NULL when the text was not exactly
    one JSON object (trailing text, several values, a scalar or an array).  ``object_known``: the text
    passed ``starts_object`` before it was wrapped."""
    wrapped = _col(wrapped)
    first = F.try_variant_get(wrapped, "$[0]", "variant")
    ok = _alone(wrapped)
    if not object_known:
        ok = ok & F.schema_of_variant(first).startswith("OBJECT")
    return F.when(F.coalesce(ok, F.lit(False)), first)


def _alone(wrapped: Column) -> Column:
    return ((F.try_variant_get(wrapped, "$[1]", "string") == F.lit(_SENTINEL))
            & F.try_variant_get(wrapped, "$[2]", "variant").isNull())


def checked(wrapped) -> Column:
    """A wrapped parse, or NULL where ``record_of`` (of a text that begins as an object does) is NULL.  The record
    stays inside, as Spark builds every value anew that is taken out of a VARIANT; ``fields`` reads it there."""
    wrapped = _col(wrapped)
    return F.when(F.coalesce(_alone(wrapped), F.lit(False)), wrapped)


def fields(wrapped, names) -> Column:
    """``names`` of the record in a wrapped parse as a struct of VARIANTs (``a.b`` nested, NULL when absent), in
    one walk over its keys, where every ``field`` compares the name with key after key."""
    tree: dict = {}
    for name in names:
        node = tree
        for part in name.split("."):
            node = node.setdefault(part, {})

    def ddl(node: dict) -> str:
        return "struct<" + ", ".join(f"`{k}`: {ddl(sub) if sub else 'variant'}" for k, sub in node.items()) + ">"
    return F.try_variant_get(_col(wrapped), "$[0]", ddl(tree))


def parse_record(json_text) -> Column:
    """Strict parse of a record that must be exactly one JSON object.

    ``try_parse_json`` tolerates trailing text, so the record is wrapped as
    ``[<record>, "<sentinel>"]``: it is valid only if that array has exactly two
    elements, the second is the sentinel and the first is an object.  Returns the
    object as a VARIANT, or NULL for a malformed record.

    As a single expression it repeats its input three times; on DataFrames prefer
    ``wrap_record`` and ``record_of`` in two projections (``stage.parse_lines``), so
    the text is built and parsed once per line.
    """
    return record_of(wrap_record(json_text))


_DUPLICATES = "spark.sql.variant.allowDuplicateKeys"


@contextmanager
def tolerant_json(spark: SparkSession) -> Iterator[None]:
    """Objects may repeat a key: of its values the last counts.  Spark decides this by a setting when a
    query is planned, so a parse must be built and run (written) inside the block; afterwards the
    session's setting is what it was."""
    before = spark.conf.get(_DUPLICATES)
    spark.conf.set(_DUPLICATES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DUPLICATES, before)


def repeats_field(json_text, names) -> Column:
    """Whether an object's own keys hold one of ``names`` twice (keys of nested objects do not count)."""
    known = F.array(*[F.lit(n) for n in names])
    keys = F.json_object_keys(_col(json_text))
    own = F.filter(keys, lambda k: F.array_contains(known, k))
    # Few records repeat any key; only their keys are looked at by name.
    return F.coalesce(F.when(F.size(keys) > F.size(F.array_distinct(keys)), F.size(own) > F.size(F.array_distinct(own))),
                      F.lit(False))


def field(record, name: str) -> Column:
    """A field of a parsed record as a VARIANT (NULL when absent); ``a.b`` is nested."""
    path = "$" + "".join(f"['{part}']" for part in name.split("."))
    return F.try_variant_get(_col(record), path, "variant")


def vtype(v) -> Column:
    return F.schema_of_variant(_col(v))


def is_object(v) -> Column:
    return vtype(v).startswith("OBJECT")


def shortest_float_text(d) -> Column:
    """A double as shortest round-trip text: plain for 1e-5 <= |x| < 1e16 (``100.0``,
    ``0.0025``), else ``1e16`` / ``1.5e-7`` -- how the reference prints a parsed float.

    Spark keeps the shortest digits in both conversions used here: to
    ``decimal(38,22)`` (exact for 17 significant digits anywhere in the plain range)
    and to string, which only needs its ``1.0E7`` spelling changed outside that range.
    """
    x = _col(d)
    plain = F.regexp_replace(F.regexp_replace(x.cast("decimal(38,22)").cast("string"), "0+$", ""), r"\.$", ".0")
    expo = F.regexp_replace(F.regexp_replace(x.cast("string"), r"\.0E", "E"), "E", "e")
    return F.when((F.abs(x) >= 1e-5) & (F.abs(x) < 1e16), plain).otherwise(expo)


_U64_MAX = "18446744073709551615"


def _number_text(v: Column, ty: Column) -> Column:
    """Text of a JSON number as the reference prints it.

    Integers arrive as BIGINT (or, between 2^63 and 2^64, as DECIMAL(19|20,0)) and print
    exactly.  Numbers with a fraction, exponent or trailing ``.0`` are floats for the
    reference: short decimals print as written (``1.0``, ``112946.26``), the rest
    through the double's shortest text.
    """
    s = F.try_variant_get(v, "$", "string")
    x = F.try_variant_get(v, "$", "double")
    short_decimal = ty.rlike(r"^DECIMAL\(([1-9]|1[0-5]),") & ((x == 0) | (F.abs(x) >= 1e-5))
    u64 = ty.rlike(r"^DECIMAL\((19|20),0\)$") & (s.try_cast("decimal(20,0)") <= F.lit(_U64_MAX).cast("decimal(20,0)"))
    return (F.when(ty == "BIGINT", s)
            .when(short_decimal, F.when(ty.endswith(",0)"), F.concat(s, F.lit(".0"))).otherwise(s))
            .when(u64, s)
            .when(ty.startswith("DECIMAL") | (ty == "DOUBLE"), shortest_float_text(x)))


def lenient_string(v) -> Column:
    """A trimmed non-empty string, or a number as text; anything else is NULL."""
    v = _col(v)
    ty = vtype(v)
    # Trimmed in the first condition, which Spark evaluates for every row: so the result does not trim again.
    t = trim_ws(F.try_variant_get(v, "$", "string"))
    return F.when((ty == "STRING") & (t != ""), t).otherwise(_number_text(v, ty))


def text_or_value(v) -> Column:
    """J2 of ``.value`` for an object (``{"type": "/type/text", "value": ...}``), else J2."""
    v = _col(v)
    return F.coalesce(lenient_string(F.try_variant_get(v, "$['value']", "variant")), lenient_string(v))


def lenient_int(v) -> Column:
    """An int32 from a JSON integer or a trimmed numeric string (``+5`` and ``007`` ok).

    Floats, booleans and out-of-range values give NULL.
    """
    v = _col(v)
    ty = vtype(v)
    t = trim_ws(F.try_variant_get(v, "$", "string"))
    return (
        F.when(ty == "BIGINT", F.try_variant_get(v, "$", "int"))
        .when((ty == "STRING") & t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("int"))
    )


def lenient_array(v, fn, element_type: str) -> Column:
    """Map ``fn`` over a JSON array and drop NULLs; a non-array gives an empty array."""
    arr = F.try_variant_get(_col(v), "$", "array<variant>")
    mapped = F.filter(F.transform(arr, lambda x: fn(x)), lambda x: x.isNotNull())
    return F.coalesce(mapped, F.array().cast(f"array<{element_type}>"))


def string_array(v) -> Column:
    """Array of lenient strings."""
    return lenient_array(v, lenient_string, "string")


def _positive_int(x: Column) -> Column:
    n = F.when(vtype(x) == "BIGINT", F.try_variant_get(x, "$", "int"))
    return F.when(n > 0, n)


def int_array(v) -> Column:
    """JSON integers in int32 range and > 0 (drops -1 "deleted" marks, strings, floats)."""
    return lenient_array(v, _positive_int, "int")


def short_key(c) -> Column:
    """Last path segment of a key (``/authors/OL1A`` -> ``OL1A``)."""
    return F.substring_index(_col(c), "/", -1)


def ref_key(x, depth: int = 4) -> Column:
    """J8 element: a string gives its last path segment; an object recurses into ``key``.

    The first ``depth`` levels are native terms; only where an object is left below them
    does a loop go on, as deep as the parser accepts documents.
    """
    x = _col(x)
    terms = []
    path = "$"
    for _ in range(depth):
        node = F.try_variant_get(x, path, "variant")
        terms.append(F.when(vtype(node) == "STRING", short_key(F.try_variant_get(node, "$", "string"))))
        path += "['key']"
    node = F.try_variant_get(x, path, "variant")
    last = F.aggregate(F.sequence(F.lit(1), F.lit(MAX_NESTING)), node, lambda n, _: F.when(
        vtype(n).startswith("OBJECT"), F.try_variant_get(n, "$['key']", "variant")).otherwise(n))
    deep = F.when(vtype(node) == "STRING", short_key(F.try_variant_get(node, "$", "string"))).when(
        vtype(node).startswith("OBJECT"),
        F.when(vtype(last) == "STRING", short_key(F.try_variant_get(last, "$", "string"))))
    return F.coalesce(*terms, deep)


def key_ref_array(v) -> Column:
    """Array of reference keys (``[{"key": "/works/OL1W"}]`` or bare key strings)."""
    return lenient_array(v, ref_key, "string")


def _author_role_key(x: Column) -> Column:
    return F.coalesce(ref_key(F.try_variant_get(x, "$['author']", "variant")), ref_key(x))


def author_role_keys(v) -> Column:
    """Work author list; an object gives its ``author`` ref, else its own ``key``; order kept."""
    return lenient_array(v, _author_role_key, "string")


def first_accepted(v, fn, element_type: str) -> Column:
    """J5 + J11: the first array element that ``fn`` accepts, or NULL.

    Element 0 is tried directly; only when it is junk (or ``v`` is not an array) is
    the whole array mapped and filtered.  Same result as ``first(lenient_array(...))``
    while skipping the per-element lambda work in the common case.
    """
    v = _col(v)
    return F.coalesce(fn(F.try_variant_get(v, "$[0]", "variant")), F.get(lenient_array(v, fn, element_type), 0))


def first_string(v) -> Column:
    return first_accepted(v, lenient_string, "string")


def first_ref_key(v) -> Column:
    """The first reference key of an array.  A text that begins with a slash comes from a JSON string, so where
    the first element is such a one, or has it as its ``key``, no type is looked at."""
    v = _col(v)
    named, bare = (F.try_variant_get(v, path, "string") for path in ("$[0]['key']", "$[0]"))
    return F.coalesce(F.when(named.startswith("/"), short_key(named)),
                      F.when(named.isNull() & bare.startswith("/"), short_key(bare)),
                      first_accepted(v, ref_key, "string"))


def first_positive_int(v) -> Column:
    return first_accepted(v, _positive_int, "int")


def first_convertible(v) -> Column:
    """First element of an array that J2 accepts, or J2 of a scalar."""
    v = _col(v)
    return F.coalesce(first_string(v), lenient_string(v))


def identifiers(v, names=("amazon", "goodreads", "google")) -> Column:
    """External ids, one struct field per name."""
    v = _col(v)
    return F.struct(*[first_convertible(F.try_variant_get(v, f"$['{n}']", "variant")).alias(n) for n in names])


def first(arr) -> Column:
    """First element or NULL (``get`` is safe under ANSI mode)."""
    return F.get(_col(arr), 0)
