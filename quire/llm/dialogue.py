"""Repair of conversation structure.

A conversation's turns, in order, get the cheapest edits after which the roles' initials read
``(s?(ua)+)?``: Keep, Rerole (to user or assistant), Delete, Insert (an empty user or assistant
turn).  Of equally cheap edits those win whose initials, read as one string, come first in ASCII.

Both are decided by one integer per path of a DAG whose nodes are (turn, last role): its high
digits are the cost; below them every turn has a slot of fixed width with the letters of its
edits (``D``, ``IK``, ``IR``, ``K``, ``R``; an insert stands before the turn it makes room for,
as ``D`` comes before ``I``), filled with zeros at the end.  No filled slot is the beginning of another, so
the least integer is the cheapest and then the ASCII-least, and an ordinary shortest-path pass
finds it; its low digits are read back as the edits.

A conversation of any length is spread over tasks.  Its turns are numbered by a range
partition, and ``CHUNK`` of them at a time are solved from every role to every role.  ``CHUNK`` such
results are then turns of a coarser DAG of the same kind, their slots holding the rank of their
letters, and so on until one is left; the choices made there are handed down again.  Only the
audit string and the digest of a repaired conversation are made in one task; the digest reads
the texts as a stream.

Faults of a turn, the first that applies: ``blank`` (no character but white space),
``duplicate`` (role and text occur earlier), ``truncated`` (the last character that is not white
space is none of ``.!?``).  Blank and duplicate turns must be deleted; keeping a truncated one costs
``TRUNCATED`` more.

Defined cases: turns are ordered by turn (nulls first), role and SHA-256 of the text; a null role or
text reads as one space; a role counts by its first character; a null conversation is one
like any other; equal rows are copies, kept apart by a count (so copies beyond the first are
duplicates); texts of any length are read whole; an empty table has no conversations.  Only
the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import importable, table, written
from quire.operators.rank import rank_within_groups

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3   # costs
CHUNK = 256           # turns, or results of chunks, solved at once
BLANK = "\x20\t\n\x0b\x0c\r"

# States: nothing yet, or the initial of the last role.
START, SYSTEM, USER, ASSISTANT = range(4)
OTHER = 0             # an initial that no repaired conversation has
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
# Slots: two letters of three bits, a zero where there is none.
LETTER = {"D": 1, "I": 2, "K": 3, "R": 4}
WIDTH = 6


def slot(letters: str) -> int:
    return sum(LETTER[x] << 3 * (1 - k) for k, x in enumerate(letters))


SLOT = {slot(x): x for x in ("D", "IK", "IR", "K", "R")}
#: What may follow the last turn: (state, cost, slot of the letters).
ENDINGS = {START: (0, 0), ASSISTANT: (0, 0), USER: (INSERT, slot("I")), SYSTEM: (2 * INSERT, slot("II"))}
ENDING = {0: "", slot("I"): "I", slot("II"): "II"}

Edges = list[tuple[int, int, int, int]]   # state, next state, cost, digit


def other(state: int) -> int:
    """The role that has to follow."""
    return ASSISTANT if state == USER else USER


def turn_edges(initial: int, gone: bool, truncated: bool, copies: int) -> Edges:
    """The edits of a turn; its further copies are deleted in any case."""
    copied = DELETE * (copies - 1)
    edges = [(q, q, DELETE + copied, slot("D")) for q in range(4)]
    if gone:
        return edges
    extra = copied + (TRUNCATED if truncated else 0)
    if initial == SYSTEM:
        edges.append((START, SYSTEM, KEEP + extra, slot("K")))
    for q in range(4):
        for role in (USER, ASSISTANT):
            letter, cost = ("K", KEEP) if role == initial else ("R", REROLE)
            if role == other(q):
                edges.append((q, role, cost + extra, slot(letter)))
            else:
                edges.append((q, role, INSERT + cost + extra, slot("I" + letter)))
    return edges


def least(items: list[Edges], start: int, ending: bool) -> list[int | None]:
    """The least integer of a path from ``start`` to every state, over all items."""
    slots = len(items) + ending
    high = WIDTH * slots
    best: list[int | None] = [None] * 4
    best[start] = 0
    for k, edges in enumerate(items):
        low, found = WIDTH * (slots - 1 - k), [None] * 4
        for q, to, cost, digit in edges:
            if best[q] is not None:
                weight = best[q] + (cost << high) + (digit << low)
                if found[to] is None or weight < found[to]:
                    found[to] = weight
        best = found
    if ending:
        best = [None if b is None else b + (ENDINGS[q][0] << high) + ENDINGS[q][1] for q, b in enumerate(best)]
    return best


def digits(weight: int, slots: int) -> tuple[int, list[int]]:
    """The cost of a path and the digit of every slot."""
    return weight >> WIDTH * slots, [weight >> WIDTH * (slots - 1 - k) & 63 for k in range(slots)]


def summary(items: list[Edges]) -> Edges:
    """All items as one: from every state to every state the least cost, and as digit the
    rank of its letters among those that start from the same state."""
    edges = []
    for q in range(4):
        found = [(to, w) for to, w in enumerate(least(items, q, False)) if w is not None]
        low = (1 << WIDTH * len(items)) - 1
        ranks = {v: r + 1 for r, v in enumerate(sorted({w & low for _, w in found}))}
        edges += [(q, to, w >> WIDTH * len(items), ranks[w & low]) for to, w in found]
    return edges


@dataclass
class Turns:
    """The turns of a chunk, read from their codes, and what is counted about them."""
    items: list[Edges]
    copies: list[int]
    initials: list[int]
    counts: tuple[int, int, int, int]    # blank, duplicate, truncated, illegal

    @classmethod
    def read(cls, codes: list[int]) -> Turns:
        items, copies, initials = [], [], []
        blank = duplicate = truncated = illegal = 0
        before, first = None, False
        for code in codes:
            if code <= -2:
                before = -2 - code
            elif code == -1:
                first = True
            else:
                m, cut, empty, initial = code >> 4, bool(code & 8), bool(code & 4), code & 3
                illegal += (m - 1) + (before is not None and (before, initial) not in LEGAL)
                if empty:
                    blank += m
                else:
                    duplicate += m - first
                    truncated += first and cut
                items.append(turn_edges(initial, empty or not first, cut, m))
                copies.append(m)
                initials.append(initial)
                before, first = initial, False
        return cls(items, copies, initials, (blank, duplicate, truncated, illegal))


def choose(items: list[Edges], start: int, to: int | None) -> tuple[int, list[int], int]:
    """Cost, digits, and the slot of the ending of the least path; ``to`` None: whichever is best."""
    found = least(items, start, to is None)
    weight = min(w for w in found if w is not None) if to is None else found[to]
    cost, low = digits(weight, len(items) + (to is None))
    return (cost, low[:-1], low[-1]) if to is None else (cost, low, 0)


_PART = ("struct<blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string,ending:string,"
         "letters:array<string>,roles:array<string>,inserted:array<string>>")


def _part(codes: list[int], start: int, to: int | None) -> dict:
    turns = Turns.read(codes)
    cost, low, end = choose(turns.items, start, to)
    letters, roles, inserted, audit, state = [], [], [], [], start
    for digit, copies, initial in zip(low, turns.copies, turns.initials):
        edit = SLOT[digit]
        new = None
        if "I" in edit:
            state = other(state)
        inserted.append(ROLE[state] if "I" in edit else None)
        if edit[-1] == "R":
            new = state = other(state)
        elif edit[-1] == "K":
            state = initial
        letters.append(edit)
        roles.append(ROLE.get(new))
        audit.append(edit + "D" * (copies - 1))
    names = ("blank", "duplicate", "truncated", "illegal")
    return dict(zip(names, turns.counts), cost=cost, audit="".join([*audit, ENDING[end]]), ending=ENDING[end],
                letters=letters, roles=roles, inserted=inserted)


def _solved(codes: Column, start: Column, to: Column) -> Column:
    @F.arrow_udf(_PART)
    def part(codes: pa.Array, start: pa.Array, to: pa.Array) -> pa.Array:
        return pa.array([_part(*row) for row in zip(codes.to_pylist(), start.to_pylist(), to.to_pylist())],
                        pa.struct([*((x, pa.int64()) for x in ("blank", "duplicate", "truncated", "illegal", "cost")),
                                   ("audit", pa.string()), ("ending", pa.string()),
                                   *((x, pa.list_(pa.string())) for x in ("letters", "roles", "inserted"))]))
    return part(codes, start, to)


def _summaries(items: Column, read) -> Column:
    """Edges, four numbers each, of many items taken as one."""
    @F.arrow_udf("array<long>")
    def edges(items: pa.Array) -> pa.Array:
        return pa.array([[n for e in summary(read(i)) for n in e] for i in items.to_pylist()], pa.list_(pa.int64()))
    return edges(items)


def _edges(numbers: list[int]) -> Edges:
    return list(zip(numbers[::4], numbers[1::4], numbers[2::4], numbers[3::4]))


def _steps(children: Column, start: Column, to: Column) -> Column:
    """The state before and after every child of the best path."""
    @F.arrow_udf("array<struct<start:int,to:int>>")
    def steps(children: pa.Array, start: pa.Array, to: pa.Array) -> pa.Array:
        found = []
        for own, state, end in zip(children.to_pylist(), start.to_pylist(), to.to_pylist()):
            items, path = [_edges(c) for c in own], []
            for edges, digit in zip(items, choose(items, state, end)[1]):
                after = next(t for q, t, _, d in edges if (q, d) == (state, digit))
                path.append({"start": state, "to": after})
                state = after
            if end is None:
                path[-1]["to"] = None    # the last chunk finds the ending itself
            found.append(path)
        return pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("to", pa.int32())])))
    return steps(children, start, to)


def _choices(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, start, to) of the conversations of several chunks: results of chunks are
    gathered level by level, and the choices of the coarsest are handed down."""
    # Rows of one level are grouped by (conv, number of the group): at most CHUNK in each.
    level = chunks.select("conv", F.col("chunk").alias("at"),
                          _summaries(F.col("codes"), lambda c: Turns.read(c).items).alias("edges"))
    levels, more = [], True
    while more:
        group = F.floor(F.col("at") / CHUNK)
        above = level.groupBy("conv", group.alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("at", "edges"))).alias("own"))
        above = written(above.select("conv", "up", F.transform("own", lambda x: x["at"]).alias("ats"),
                                     F.transform("own", lambda x: x["edges"]).alias("children")), "levels")
        levels.append(above)
        level = above.select("conv", F.col("up").alias("at"),
                             _summaries(F.col("children"), lambda c: [_edges(x) for x in c]).alias("edges"))
        more = not above.where("up > 0").limit(1).isEmpty()
    none = F.lit(None).cast("int")
    chosen = levels[-1].select("conv", F.col("up").alias("chunk"), F.lit(START).alias("start"), none.alias("to"))
    for above in reversed(levels):
        rows = above.join(chosen.withColumnRenamed("chunk", "up"), ["conv", "up"])
        steps = F.arrays_zip(F.col("ats"), _steps(F.col("children"), F.col("start"), F.col("to")).alias("step"))
        rows = rows.select("conv", F.explode(steps).alias("x"))
        chosen = rows.select("conv", F.col("x.ats").alias("chunk"), F.col("x.step.start").alias("start"),
                             F.col("x.step.to").alias("to"))
        chosen = written(chosen, "choices")
    return chosen


@dataclass
class Repair:
    """``turns``: (conv, turn, role, digest, text, copies), one row for equal rows;
    ``edits``: (conv, at, turn, role, digest, letters, new_role, inserted), in order of ``at``;
    ``report``: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, ending).  ``conv``
    is a struct of whether the conversation is null, and it."""
    turns: DataFrame
    edits: DataFrame
    report: DataFrame


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           copies: Column | None = None) -> Repair:
    importable(rows.sparkSession)
    named = rows.select(_key(conv), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
                        (F.lit(1) if copies is None else copies).cast("long").alias("copies"))
    turns = named.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    turns = written(turns.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))), "turns")
    bare = F.rtrim(F.col("text"), F.lit(BLANK))
    initial = F.left("role", F.lit(1))
    state = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    flags = (F.when(F.right(bare, F.lit(1)).isin(".", "!", "?"), 0).otherwise(8) + F.when(bare == "", 4).otherwise(0) + state)
    narrow = turns.select("conv", F.struct("turn", "role", "digest").alias("key"),
                          (F.col("copies") * 16 + flags).alias("code"), state.alias("state"), (bare == "").alias("blank"))
    numbered = rank_within_groups(narrow, "conv", "key", out="at").withColumn("at", F.col("at") - 1)
    numbered = written(numbered.withColumn("chunk", F.floor(F.col("at") / CHUNK)), "numbered")
    # Per chunk its turns' codes in order; a mark (-1) before the first of a role and text, and
    # the initial of the turn before the chunk (-2 and less).
    first = numbered.where("NOT blank").groupBy("conv", "key.role", "key.digest").agg(F.min("at").alias("at"))
    marks = first.select("conv", F.floor(F.col("at") / CHUNK).alias("chunk"), "at", F.lit(0).alias("kind"),
                         F.lit(-1).cast("long").alias("code"), F.lit(None).cast(narrow.schema["key"].dataType).alias("key"))
    ends = numbered.where(F.col("at") % CHUNK == CHUNK - 1)
    marks = marks.unionByName(ends.select("conv", (F.col("chunk") + 1).alias("chunk"), "at", F.lit(0).alias("kind"),
                                          (-2 - F.col("state")).cast("long").alias("code"),
                                          F.lit(None).cast(narrow.schema["key"].dataType).alias("key")))
    entries = numbered.select("conv", "chunk", "at", F.lit(1).alias("kind"), "code", "key").unionByName(marks)
    own = F.sort_array(F.collect_list(F.struct("at", "kind", "code", "key")))
    chunks = entries.groupBy("conv", "chunk").agg(own.alias("own"))
    real = F.filter("own", lambda x: x["kind"] == 1)
    chunks = chunks.select("conv", "chunk", F.transform("own", lambda x: x["code"]).alias("codes"),
                           F.transform(real, lambda x: x["key"]).alias("keys"),
                           F.transform(real, lambda x: x["at"]).alias("ats")).where(F.size("ats") > 0)
    chunks = written(chunks, "chunks")
    none = F.lit(None).cast("int")
    long = written(chunks.where("chunk > 0").select("conv").distinct(), "long")
    if long.isEmpty():
        chosen = chunks.select("*", F.lit(START).alias("start"), none.alias("to"))
    else:
        chosen = chunks.join(long, "conv", "left_anti").select("*", F.lit(START).alias("start"), none.alias("to"))
        several = chunks.join(long, "conv", "left_semi")
        chosen = chosen.unionByName(several.join(_choices(several), ["conv", "chunk"]))
    parts = written(chosen.select("conv", "chunk", "ats", "keys",
                                  _solved(F.col("codes"), F.col("start"), F.col("to")).alias("p")), "parts")
    edits = parts.select("conv", F.inline(F.arrays_zip(
        F.col("ats").alias("at"), F.col("keys").alias("key"), F.col("p.letters").alias("letters"),
        F.col("p.roles").alias("new_role"), F.col("p.inserted").alias("inserted"))))
    edits = edits.select("conv", "at", "key.turn", "key.role", "key.digest", "letters", "new_role", "inserted")
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    audit = F.sort_array(F.collect_list(F.struct("chunk", "p.audit")))
    report = parts.groupBy("conv").agg(*[F.sum(f"p.{x}").alias(x) for x in counts], audit.alias("parts"),
                                       F.max("p.ending").alias("ending"))
    report = report.withColumn("audit", F.array_join(F.transform("parts", lambda x: x["audit"]), "")).drop("parts")
    span = F.max("t").cast("decimal(20,0)") - F.min("t").cast("decimal(20,0)") + 1 - F.count_distinct("t")
    gaps = numbered.select("conv", F.col("key.turn").alias("t")).groupBy("conv").agg(
        F.coalesce(span.try_cast("long"), F.lit(0)).alias("gaps"))
    return Repair(turns, edits, report.join(gaps, "conv"))


def _key(conv: str) -> Column:
    return F.struct(F.col(conv).isNull().alias("none"), F.col(conv).alias("id")).alias("conv")


def repaired(found: Repair) -> DataFrame:
    """The turns of the repaired conversations: (conv, at, step, role, text), to be read in the order of
    ``at`` and ``step``; at the end ``at`` is null."""
    same = ["conv", "turn", "role", "digest"]
    kept = found.edits.where("letters <> 'D'")
    texts = found.turns.select(*[F.col(c).alias("t_" + c) for c in same], "text")
    match = [F.col(c).eqNullSafe(F.col("t_" + c)) for c in same]
    rows = kept.join(texts, match[0] & match[1] & match[2] & match[3])
    rows = rows.select("conv", "at", F.lit(1).alias("step"), F.coalesce("new_role", "role").alias("role"), "text")
    extra = kept.where("inserted IS NOT NULL").select("conv", "at", F.lit(0).alias("step"), F.col("inserted").alias("role"),
                                                      F.lit("").alias("text"))
    last = found.report.select("conv", F.lit(None).cast("long").alias("at"),
                               F.posexplode(F.slice(F.array(F.lit("user"), F.lit("assistant")),
                                                    3 - F.length("ending"), F.length("ending"))).alias("step", "role"),
                               F.lit("").alias("text"))
    return rows.unionByName(extra).unionByName(last)


def digests(found: Repair) -> DataFrame:
    """(conv, sha256) of ``role:text`` of a conversation's repaired turns, joined by new lines.  Edits and
    texts meet by sorting, a conversation after the other; a task keeps one turn at a time."""
    null = F.lit(None)
    edits = found.edits.where("letters <> 'D'").select(
        "conv", F.lit(0).alias("last"), "turn", "role", "digest", F.lit(0).alias("kind"), "new_role", "inserted",
        null.cast("string").alias("text"))
    texts = found.turns.select("conv", F.lit(0).alias("last"), "turn", "role", "digest", F.lit(1).alias("kind"),
                               null.cast("string").alias("new_role"), null.cast("string").alias("inserted"), "text")
    ends = found.report.select("conv", F.lit(1).alias("last"), null.cast(found.turns.schema["turn"].dataType).alias("turn"),
                               F.lit("").alias("role"), F.lit(b"").alias("digest"), F.lit(2).alias("kind"),
                               null.cast("string").alias("new_role"), F.col("ending").alias("inserted"),
                               null.cast("string").alias("text"))
    rows = edits.unionByName(texts).unionByName(ends).repartition("conv").sortWithinPartitions(
        "conv", "last", "turn", "role", "digest", "kind")
    rows = rows.select("conv", "kind", "role", "new_role", "inserted", "text")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type, sha, edit, begun = None, hashlib.sha256(), None, False
        for batch in batches:
            convs, out = [], []
            conv_type = batch.schema.field("conv").type
            column = {n: batch[n] for n in batch.schema.names}
            for k, kind in enumerate(batch["kind"].to_pylist()):
                if kind == 0:
                    edit = column["new_role"][k].as_py(), column["inserted"][k].as_py()
                    continue
                lines = []
                if kind == 1 and edit is not None:
                    new, inserted = edit
                    lines = [inserted + ":"] if inserted else []
                    lines.append((new or column["role"][k].as_py()) + ":" + column["text"][k].as_py())
                    edit = None
                elif kind == 2:
                    lines = ["user:", "assistant:"][2 - len(column["inserted"][k].as_py()):]
                for line in lines:
                    sha.update((("\n" if begun else "") + line).encode("utf-8", "surrogatepass"))
                    begun = True
                if kind == 2:   # the end of a conversation
                    convs.append(column["conv"][k].as_py())
                    out.append(sha.hexdigest())
                    sha, begun = hashlib.sha256(), False
            if out:
                yield pa.record_batch({"conv": pa.array(convs, conv_type), "sha256": pa.array(out, pa.string())})

    conv = rows.schema["conv"].dataType.simpleString()
    return rows.mapInArrow(stream, f"conv {conv}, sha256 string")


# --- the query ----------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """The query's damage to (conv_id, turn, role, text), chosen by a checksum of the key; a turn
    that is repeated has two ``copies``."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    hit = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), space)
    return rows.select(
        "conv_id", "turn", F.when(hit == 4, "user").otherwise(F.coalesce(F.col("role"), space)).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(hit == 3, 2).otherwise(1).alias("copies"), hit.alias("hit")).where("hit <> 0").drop("hit")


def op13_conversations(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = repair(damaged(rows), copies=F.col("copies"))
    done = found.report.join(digests(found), "conv")
    every = rows.select(_key("conv_id")).distinct()
    zero = F.lit(0).cast("long")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(done, "conv", "left").select(
        F.col("conv.id").alias("conv_id"), *[F.coalesce(F.col(c), zero).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def _plus(key: str, cost: str, letters: str) -> str:
    """A key (nine digits of cost, then the letters) after one more edit; null stays null."""
    return f"(lpad(CAST(CAST({key}[1:9] AS INT) + {cost} AS VARCHAR), 9, '0') || {key}[10:] || {letters})"


def _into(role: str, same: str, rest: tuple[str, ...]) -> str:
    """The least key that ends in a role: the turn is deleted, or put after another role (``rest``), or
    after an insert behind the same role."""
    letter, cost = f"CASE WHEN ini = '{role}' THEN 'K' ELSE 'R' END", f"(cut + CASE WHEN ini = '{role}' THEN 0 ELSE 3 END)"
    put = [_plus(q, cost, letter) for q in rest] + [_plus(q, f"{cost} + 3", f"'I' || {letter}") for q in same.split()]
    return f"least({_plus('k' + role, '4', repr('D'))}, CASE WHEN ok THEN least({', '.join(put)}) END)"


OP13_SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(generate_series(0, 255), lambda i: list_reduce(list_prepend(i, generate_series(1, 8)),
           lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
r AS (
  SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), 'null') AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (
  SELECT r.*, CAST(xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
         list_transform(generate_series(1, length(k)), lambda i: CAST(ascii(k[i]) AS BIGINT))),
         lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS BIGINT) % 20 AS hit FROM r, crc),
d AS (
  SELECT c, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, unnest(generate_series(1, CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))),
g AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM d),
f AS (
  SELECT *, left(role, 1) AS ini, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS seen,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS open FROM g),
o AS (
  SELECT *, NOT blank AND NOT seen AS ok, CASE WHEN open AND NOT blank AND NOT seen THEN 3 ELSE 0 END AS cut,
         lag(ini) OVER (PARTITION BY c ORDER BY i) AS before FROM f),
p AS (
  SELECT DISTINCT c, 0 AS i, '000000000' AS k0, CAST(NULL AS VARCHAR) AS ks, CAST(NULL AS VARCHAR) AS ku, CAST(NULL AS VARCHAR) AS ka
  FROM o
  UNION ALL
  SELECT p.c, CAST(o.i AS INT), {_plus('k0', '4', repr('D'))},
         least({_plus('ks', '4', repr('D'))}, CASE WHEN ok AND ini = 's' THEN {_plus('k0', 'cut', repr('K'))} END),
         {_into('u', 'ku', ('k0', 'ks', 'ka'))}, {_into('a', 'k0 ks ka', ('ku',))}
  FROM p JOIN o ON o.c = p.c AND o.i = p.i + 1),
e AS (
  SELECT c, CAST(best[1:9] AS BIGINT) AS cost, best[10:] AS audit FROM (
    SELECT c, least(k0, ka, {_plus('ku', '3', repr('I'))}, {_plus('ks', '6', repr('II'))}) AS best
    FROM p WHERE i = (SELECT max(i) FROM o WHERE o.c = p.c))),
l AS (
  SELECT c, j, letter, sum(CASE WHEN letter = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY c ORDER BY j) AS i,
         sum(CASE WHEN letter = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY c ORDER BY j) AS out
  FROM (SELECT c, audit[j] AS letter, j FROM (SELECT c, audit, unnest(generate_series(1, length(audit))) AS j FROM e))),
s AS (
  SELECT l.*, o.role, o.text, o.ini,
         max(CASE WHEN out = 1 AND letter = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.c) AS sys
  FROM l LEFT JOIN o ON o.c = l.c AND o.i = l.i AND letter <> 'I' WHERE letter <> 'D'),
x AS (
  SELECT c, string_agg(CASE letter WHEN 'K' THEN role ELSE CASE WHEN (out - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END END
                       || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS body FROM s GROUP BY c),
n AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(CASE WHEN blank THEN 1 END) AS blank, count(CASE WHEN seen AND NOT blank THEN 1 END) AS duplicate,
         count(CASE WHEN open AND ok THEN 1 END) AS truncated,
         count(CASE WHEN before || ini NOT IN ('su', 'ua', 'au') THEN 1 END) AS illegal FROM o GROUP BY c)
SELECT q.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM r) q LEFT JOIN n ON n.c = q.c LEFT JOIN e ON e.c = q.c LEFT JOIN x ON x.c = q.c
"""
