"""Conversation repair against a plain search over letters, and across chunk borders."""

import functools
import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from quire.llm import dialogue as D

SCHEMA = "conv_id long, turn long, role string, text string, conv string, at string, code int"
SPACE = " \t\n\x0b\x0c\r"


def harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def brute(rows):
    """The contract's columns of one conversation's damaged rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    turns = {r[1] for r in rows if r[1] is not None}
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else
                      "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    pairs = list(zip([r[2][:1] for r in rows], [r[2][:1] for r in rows][1:]))

    def moves(last):    # roles that may follow, by the last initial
        return {"": "su", "s": "u", "u": "a", "a": "u"}[last]

    @functools.cache
    def best(k, last, inserts):
        """Least (cost, audit, lines) from turn k on; at most two inserts in a row."""
        found = []
        if k == len(rows):
            if last in ("", "a"):
                found.append((0, "", ()))
        else:
            _, _, role, text = rows[k]
            extra = 3 if faults[k] == "truncated" else 0
            c, a, lines = best(k + 1, last, 0)
            found.append((4 + c, "D" + a, lines))
            if faults[k] not in ("blank", "duplicate"):
                if role[:1] and role[:1] in moves(last):
                    c, a, lines = best(k + 1, role[:1], 0)
                    found.append((extra + c, "K" + a, (f"{role}:{text}", *lines)))
                for new in ("user", "assistant"):
                    if new[0] in moves(last):
                        c, a, lines = best(k + 1, new[0], 0)
                        found.append((3 + extra + c, "R" + a, (f"{new}:{text}", *lines)))
        if inserts < 2:
            for new in ("user", "assistant"):
                if new[0] in moves(last):
                    c, a, lines = best(k, new[0], inserts + 1)
                    found.append((3 + c, "I" + a, (f"{new}:", *lines)))
        return min(found, key=lambda f: f[:2], default=(10 ** 9, "", ()))

    cost, audit, lines = best(0, "", 0)
    return ((max(turns) - min(turns) + 1 - len(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def sample():
    rng = random.Random(7)
    roles = ["user", "assistant", "system", None, "", "tool", "unknown", "user", "assistant", "user"]
    texts = ["Yes.", "no", "Why?  ", None, "", " \n\t", "A long answer. " * 40, "And then", "Done!\n", "Done!\n", "é 日本."]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randint(1, 11)):
            rows.append((conv, None if rng.random() < 0.1 else turn + 3 * (rng.random() < 0.1), rng.choice(roles), rng.choice(texts)))
    rows += [(7, 2, "user", "same")] * 4 + [(900, 9, "user", "x " * 200_000 + "end.")]
    return rows


@pytest.mark.parametrize("chunk", [256, 3])
def test_repair_equals_a_plain_search(spark, monkeypatch, chunk):
    monkeypatch.setattr(D, "CHUNK", chunk)
    rows = sample()
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(5)
    bad = D.damaged(df)
    found = D.repair(bad.withColumns({"conv": F.lit("x"), "at": F.lit("y")}), copies=F.col("copies"))
    shas = {r.conv.id: r.sha256 for r in D.digests(found).collect()}
    got = {r.conv.id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, shas[r.conv.id])
           for r in found.report.collect()}
    own = {}
    for r in harmed(rows):
        own.setdefault(r[0], []).append(r)
    want = {c: brute(v) for c, v in own.items()}
    assert got == {c: w[0] for c, w in want.items()}
    lines = {}
    for r in sorted(D.repaired(found).collect(), key=lambda r: (r.at is None, r.at or 0, r.step)):
        lines.setdefault(r.conv.id, []).append(f"{r.role}:{r.text}")
    assert lines == {c: list(w[1]) for c, w in want.items() if w[1]}


def test_a_long_conversation_is_solved_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(D, "CHUNK", 7)
    rng = random.Random(3)
    rows = [(1, k, rng.choice(["user", "assistant", "system", "tool"]), f"turn {k % 300}" + rng.choice([".", ""])) for k in range(600)]
    found = D.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    import sys
    sys.setrecursionlimit(10_000)
    want = brute(rows)[0]
    r = found.report.first()
    assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, D.digests(found).first().sha256) == want


def test_the_query_equals_its_sql_and_keeps_every_conversation(spark, tmp_path):
    rows = [r for r in sample() if r[0] != 900] + [(1000 + k, 0, "user", "All right.") for k in range(60)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = D.op13_conversations(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.execute(D.OP13_SQL)
    names = [c[0] for c in want.description]
    assert got.columns == names
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want.fetchall()))
    gone = [r for r in got.collect() if not r.audit]
    assert gone and all(r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in gone)
    assert got.count() == len({r[0] for r in rows})


def test_no_conversations(spark):
    found = D.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert found.report.count() == 0 == D.digests(found).count() == D.repaired(found).count()


def test_ten_copies_are_one_row_with_a_count(spark):
    rows = [(1, 0, "user", "Hi.")] * 10 + [(1, 1, "assistant", "Yes.")]
    r = D.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).report.first()
    assert (r.audit, r.cost, r.duplicate, r.illegal) == ("K" + "D" * 9 + "K", 36, 9, 9)
