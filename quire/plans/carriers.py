"""Dump lines derived from the driver's tables, so the catalogue operators can be
checked on data that grows with the tables.

Catalogue entities are played by the TPC-H-like tables: authors by ``customer`` /
``supplier``, works by ``part``, editions by ``lineitem``.  Every row of the table
becomes one dump line; the *shape* of each JSON field (string, number, object,
array with junk, absent, malformed record) is chosen from the row's own column
values, so the oracle can state the expected typed value with a ``CASE`` on the
same columns -- independent of any JSON parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.dumps import split_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table dealt by its first column, as dump lines are dealt by their number:
    the rows become JSON lines, and parsing them is the work."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), df.columns[0])


# -- JSON text builders (native expressions) ----------------------------------
def jv(c) -> Column:
    """JSON text of a string value, quoted and escaped (``\\``, ``"``, tab, CR, LF;
    the carrier columns hold no other control characters).  Plain ``replace`` calls
    measured faster here than ``to_json`` of a one-element array."""
    c = F.col(c) if isinstance(c, str) else c
    for raw, esc in (("\\", "\\\\"), ('"', '\\"'), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(raw), F.lit(esc))
    return F.concat(F.lit('"'), c, F.lit('"'))


def jq(c) -> Column:
    """JSON text of a string made of a number and fixed letters, which has nothing to escape."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def jn(c) -> Column:
    """JSON text of a number."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def jobj(*pairs) -> Column:
    """``{"k": v, ...}`` from (name, JSON text) pairs; a NULL text omits the field."""
    parts = [F.concat(F.lit(f'"{k}":'), v) for k, v in pairs]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def jarr(*items) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))


def s(text: str) -> Column:
    return F.lit(text)


def key_of(prefix: str, n, suffix: str) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"), F.lit(suffix))


def dump_rows(df: DataFrame, type_name: str, key: Column, json: Column, line_no: Column,
              revision: Column | None = None) -> DataFrame:
    """One dump line per row, then S3 (so the split is exercised too)."""
    rev = revision if revision is not None else F.lit("1")
    line = F.concat_ws("\t", F.lit(type_name), key, rev.cast("string"), F.lit("2024-01-01T00:00:00"), json)
    return split_rows(df.select(line_no.cast("bigint").alias("line_no"), line.alias("line")))


# -- authors -------------------------------------------------------------------
def customer_authors(customer: DataFrame) -> DataFrame:
    """Authors played by customers; shape class ``c_custkey % 7``."""
    k = F.col("c_custkey") % 7
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    json = (F.when(k == 0, jobj(("name", jv(name)),
                                ("bio", jobj(("type", jv(s("/type/text"))), ("value", jv(F.concat(s(" "), seg, s(" ")))))),
                                ("photos", jarr(s("-1"), jn(F.col("c_nationkey") + 1), s("5")))))
            .when(k == 1, jobj(("personal_name", jv(name)), ("bio", jv(seg)), ("birth_date", jv(s(" 1900 "))),
                               ("death_date", s("1950"))))
            .when(k == 2, jobj(("name", jv(s("   "))), ("personal_name", jv(name)), ("photos", jv(s("x")))))
            .when(k == 3, jobj(("name", jn(F.col("c_acctbal")))))
            .when(k == 4, F.concat(s('{"name": '), jv(name)))
            .when(k == 5, jobj(("bio", jv(seg))))
            .otherwise(jobj(("name", jv(seg)), ("birth_date", jarr(jv(s("1900")))))))
    return dump_rows(customer, "/type/author", key_of("/authors/OL", F.col("c_custkey"), "A"), json,
                     F.col("c_custkey"))


def supplier_authors(supplier: DataFrame, renamed: str | None = None) -> DataFrame:
    """Authors played by suppliers; every fifth nation shares one name (a hot slug).

    Suppliers of nation 0 appear twice: revision 2 carries a changed name and wins.
    With ``renamed``, a later dump: one line per supplier named ``renamed + s_name``.
    """
    if renamed is not None:
        return dump_rows(supplier, "/type/author", key_of("/authors/OL", F.col("s_suppkey"), "A"),
                         jobj(("name", jv(F.concat(F.lit(renamed), F.col("s_name"))))), F.col("s_suppkey"), F.lit(5))
    hot = (F.col("s_nationkey") % 5) == 0
    name = F.when(hot, s("Anonymous")).otherwise(F.col("s_name"))
    base = supplier.select("s_suppkey", name.alias("name"), F.lit(1).alias("rev"), F.lit(0).alias("dup"))
    again = (supplier.where(F.col("s_nationkey") == 0)
             .select("s_suppkey", F.concat(s("Revised "), F.col("s_name")).alias("name"),
                     F.lit(2).alias("rev"), F.lit(1).alias("dup")))
    both = base.unionByName(again)
    return dump_rows(both, "/type/author", key_of("/authors/OL", F.col("s_suppkey"), "A"),
                     jobj(("name", jv(F.col("name")))), F.col("s_suppkey") * 2 + F.col("dup"), F.col("rev"))


# -- works -----------------------------------------------------------------------
def part_works_renamed(part: DataFrame) -> DataFrame:
    """A later works dump: every part titled ``Renamed <p_name>``, authored by
    suppliers ``p_partkey % 97`` and ``p_size + 1``."""
    authors = jarr(jobj(("author", jobj(("key", jv(key_of("/authors/OL", F.col("p_partkey") % 97, "A")))))),
                   jobj(("author", jobj(("key", jv(key_of("/authors/OL", F.col("p_size") + 1, "A")))))))
    json = jobj(("title", jv(F.concat(F.lit("Renamed "), F.col("p_name")))), ("authors", authors))
    return dump_rows(part, "/type/work", key_of("/works/OL", F.col("p_partkey"), "W"), json, F.col("p_partkey"),
                     F.lit(5))


def part_works(part: DataFrame) -> DataFrame:
    """Works played by parts; shape class ``p_partkey % 6`` (class 5 untitled,
    class 4 a title long enough to be clamped).  Authors are suppliers
    ``p_partkey % 97`` and ``p_size`` (plus junk entries)."""
    k = F.col("p_partkey") % 6
    title = (F.when(k == 5, F.lit(None))
             .when(k == 4, jv(F.repeat(F.concat(F.col("p_name"), s(" ")), 200)))
             .otherwise(jv(F.col("p_name"))))
    authors = jarr(jobj(("author", jobj(("key", jv(key_of("/authors/OL", F.col("p_partkey") % 97, "A")))))),
                   s("5"),
                   jobj(("author", jv(key_of("/authors/OL", F.col("p_size"), "A")))))
    json = jobj(("title", title),
                ("subtitle", jv(F.col("p_type"))),
                ("description", jobj(("type", jv(s("/type/text"))), ("value", jv(F.col("p_brand"))))),
                ("first_publish_date", jv(F.concat(s("c. "), (F.col("p_size") + 1950).cast("string"), s("?")))),
                ("covers", jarr(s("-1"), jn(F.col("p_size")))),
                ("subjects", jarr(jv(F.col("p_type")), jv(s(" ")), jv(F.col("p_brand")), s("3"))),
                ("authors", authors))
    return dump_rows(part, "/type/work", key_of("/works/OL", F.col("p_partkey"), "W"), json, F.col("p_partkey"))


# -- editions --------------------------------------------------------------------
def _pct(c: str) -> Column:
    """A two-decimal rate as a whole percentage (exact comparisons on doubles)."""
    return F.round(F.col(c) * 100).cast("int")


def edition_key(orderkey="l_orderkey", linenumber="l_linenumber") -> Column:
    return F.col(orderkey) * 8 + F.col(linenumber)


def lineitem_editions(lineitem: DataFrame) -> DataFrame:
    """Editions played by line items.

    No work when ``l_returnflag='R' and l_linestatus='F'``; malformed when
    ``l_tax = 0.08``; language by ``l_linenumber`` (1 eng, 2 fre, 3 spa as a bare key,
    4 ita, 5 ger, 6 none, 7 ger then eng).
    """
    lineitem = lineitem.select("*", _pct("l_discount").alias("_discount"), _pct("l_tax").alias("_tax"))
    ln = F.col("l_linenumber")
    lang = lambda code: jobj(("key", jv(s(f"/languages/{code}"))))
    languages = (F.when(ln == 1, jarr(lang("eng"))).when(ln == 2, jarr(lang("fre")))
                 .when(ln == 3, jarr(jv(s("/languages/spa")))).when(ln == 4, jarr(lang("ita")))
                 .when(ln == 5, jarr(lang("ger"))).when(ln == 7, jarr(lang("ger"), lang("eng"))))
    no_work = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    works = F.when(~no_work, jarr(jobj(("key", jq(key_of("/works/OL", F.col("l_partkey"), "W"))))))
    qty = F.col("l_quantity").cast("int")
    json = jobj(
        ("title", F.when(F.col("_discount") < 5, jq(F.concat(s("Book "), F.col("l_partkey").cast("string"))))),
        ("works", works),
        ("languages", languages),
        ("isbn_13", F.when(F.col("l_quantity") > 25, jarr(jv(s("")), jq(F.concat(s("978"), F.lpad(
            F.col("l_orderkey").cast("string"), 10, "0")))))),
        ("isbn_10", F.when(F.col("l_quantity") <= 10, jarr(jq(F.lpad(F.col("l_suppkey").cast("string"), 10, "0"))))),
        ("publish_date", F.when(F.col("l_linestatus") == "O",
                                jq(F.concat(s("c"), F.year("l_shipdate").cast("string"), s("?"))))
         .otherwise(jq(F.date_format("l_shipdate", "MMMM yyyy")))),
        ("number_of_pages", F.when(ln % 2 == 1, jn(qty)).otherwise(jq(F.concat(s(" "), qty.cast("string"), s(" "))))),
        ("identifiers", jobj(("amazon", jarr(jv(s("")), jq(F.concat(s("B"), F.col("l_orderkey").cast("string"))))),
                             ("goodreads", jn(F.col("l_suppkey"))), ("google", s("{}")))),
        ("covers", F.when(F.col("_discount") >= 2, jarr(jn(F.col("l_partkey") + 1))).otherwise(jarr(s("-1")))),
        ("physical_format", F.when(F.col("l_returnflag") == "A", jv(s("Paperback")))
         .when(F.col("l_returnflag") == "N", jv(s("Hardcover")))),
        ("publishers", jarr(jv(F.concat(F.col("l_returnflag"), s(" Press"))))),
        ("edition_name", F.when(ln == 1, jv(s("1st")))),
        ("ocaid", jq(F.concat(s("ia"), F.col("l_orderkey").cast("string")))),
    )
    json = F.concat(json, F.when(F.col("_tax") == 8, s(" trailing")).otherwise(s("")))
    return dump_rows(lineitem, "/type/edition", key_of("/books/OL", edition_key(), "M"), json, edition_line_no(),
                     edition_revision())


def edition_revision() -> Column:
    """Line items repeat (order, line number); each repeat is a distinct revision."""
    return F.col("l_partkey") * 10000 + F.col("l_suppkey")


def edition_line_no() -> Column:
    """File position of an edition line: increasing in edition key, with a scan
    chunk (8192 orders) in the high bits the way a scan partition would be."""
    chunk = F.floor(F.col("l_orderkey") / 8192).cast("bigint")
    return F.shiftleft(chunk, 33) + (F.col("l_orderkey") % 8192) * 8 + F.col("l_linenumber")
