"""Conversation repair against a plain search over whole conversations."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from orderloom.llm import conversation_repair as cr
from orderloom.llm import queries

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\v\f\r"
TURNS = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """The report of one conversation: rows (turn, role, text) in order."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, role, text in rows:
        said = text.strip(SPACE)
        faults.append("b" if not said else "d" if (role, text) in seen else "t" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    # best[s]: (cost, audit) from state s to the end; states "", "s", "u", "a" of the last role.
    best = {s: (0, "") if s in ("", "a") else (10**9, "") for s in ("", "s", "u", "a")}
    follow = {"": "u", "s": "u", "a": "u", "u": "a"}

    def inserted(best):
        for _ in range(3):
            best = {s: min(best[s], (best[follow[s]][0] + 5, "I" + best[follow[s]][1])) for s in best}
        return best

    best = inserted(best)
    table = [best]
    for (_, role, _), fault in zip(reversed(rows), reversed(faults)):
        after, best = best, {}
        for s in after:
            options = [(2 + after[s][0], "D" + after[s][1])]
            if fault not in ("b", "d"):
                more = 5 if fault == "t" else 0
                if role[:1] == follow[s] or (role[:1] == "s" and s == ""):
                    options.append((more + after[role[:1]][0], "K" + after[role[:1]][1]))
                options.append((1 + more + after[follow[s]][0], "R" + after[follow[s]][1]))
            best[s] = min(options)
        best = inserted(best)
        table.append(best)
    cost, audit = best[""]
    out, state, i = [], "", 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        _, role, text = rows[i] if edit != "I" else (None, None, "")
        state = "s" if edit == "K" and role[:1] == "s" else follow[state]
        out.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{text}")
        i += edit != "I"
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, digest)


def expected(rows):
    """Reports by conv_id of rows (conv_id, turn, role, text)."""
    found = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())
    for conv_id, turn, role, text in sorted(((c, t, r or " ", x if x is not None else " ") for c, t, r, x in rows), key=order):
        found.setdefault(conv_id, []).append((turn, role, text))
    return {c: plain(r) for c, r in found.items()}


def got(repaired):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[n] for n in names) for r in cr.report(repaired).collect()}


def made_up(seed, sizes):
    dice = random.Random(seed)
    texts = ["One.", "Two!", "Three?", "half", "", " \n", "One. ", "Four."]
    roles = ["user", "assistant", "system", "tool", "", "user", "assistant", "user", "assistant"]
    return [
        (c, dice.choice([i, i, i + 1, i + 2, None]), dice.choice(roles), dice.choice(texts) + dice.choice(["", "", str(i) + "."]))
        for c, n in enumerate(sizes)
        for i in range(n)
    ]


def test_short_conversations(spark):
    rows = made_up(1, [n % 9 for n in range(400)])
    assert got(cr.repair(spark.createDataFrame(rows, TURNS))) == expected(rows)


@pytest.mark.parametrize("chunk_rows", [1, 3, 40])
def test_conversations_of_many_chunks(spark, chunk_rows):
    rows = made_up(chunk_rows, [300, 1, 0, 70, 2])
    repaired = cr.repair(spark.createDataFrame(rows, TURNS).repartition(3), chunk_rows=chunk_rows)
    assert got(repaired) == expected(rows)


def test_vectors_that_never_converge(spark):
    # Users only: the odds of the two phases never meet, so the true vector travels through all chunks.
    rows = [(1, i, "user", f"Text {i}.") for i in range(200)] + [(1, 200, "assistant", "End."), (1, 201, "user", "no")]
    assert got(cr.repair(spark.createDataFrame(rows, TURNS), chunk_rows=2)) == expected(rows)


def test_refixed_stops_where_vectors_agree():
    codes = bytes([2, 3] * 50)
    other = (3, 0, 1, 2)
    out = cr.before_chunk(codes, cr.END)
    assert cr.refixed(codes, cr.END, other, out) == cr.before_chunk(codes, other)


def test_nulls_repeats_and_other_columns(spark, with_clashes):
    rows = [
        (None, None, None, None), (None, 1, "user", "A."), (None, 1, "user", "A."), (None, 2, "assistant", None),
        (7, None, "user", "x."), (7, None, "user", "x."), (7, None, "user", "x."), (8, 3, "system", "s."),
        (9, 1, "user", "q?"), (9, 1, "assistant", "q?"), (9, 5, "assistant", "r"),
    ]
    frame = with_clashes(spark.createDataFrame(rows, TURNS)).selectExpr("*", "1 AS whole", "2 AS who", "3 AS k", "4 AS times")
    assert got(cr.repair(frame)) == expected(rows)


@pytest.fixture
def kept_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_duplicates_across_tasks(spark, kept_partitions):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Text {i % 50}.") for i in range(4000)]
    rows += made_up(9, [0, 0, 40, 3])
    frame = spark.createDataFrame(rows, TURNS).repartition(8)
    found = cr.repair(frame, chunk_rows=100)
    assert got(found) == expected(rows)
    assert found.select("part").distinct().count() > 1


def test_empty_table_and_dropped_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert cr.report(cr.repair(empty)).count() == 0
    rows = spark.createDataFrame([(1, 1, "user", "a."), (2, 1, "user", "b.")], TURNS)
    found = got(cr.repair(rows, F.lit(True)))
    assert found == dict.fromkeys((1, 2), (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))


def test_very_long_text(spark):
    rows = [(1, 0, "user", " " * 1_000_000), (1, 1, "user", "word " * 400_000 + "."), (1, 2, "assistant", "x" * 5_000_000)]
    assert got(cr.repair(spark.createDataFrame(rows, TURNS))) == expected(rows)


def test_repaired_turns_follow_the_pattern(spark):
    rows = made_up(5, [50, 3, 20])
    repaired = cr.repair(spark.createDataFrame(rows, TURNS), chunk_rows=4)
    found = {}
    for r in sorted(cr.repaired_turns(repaired).collect(), key=lambda r: (r["part"], r["seq"], r["at"])):
        found.setdefault(r["conv_id"], []).append(r["role"][:1])
    assert all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in found.values())


def harmed(rows):
    out = []
    for conv_id, turn, role, text in rows:
        as_text = lambda v: " " if v is None else str(v)
        harm = zlib.crc32(f"{as_text(conv_id)}:{as_text(turn)}".encode()) % 20
        role, text = as_text(role), as_text(text)
        if harm:
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            out += [(conv_id, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = dict.fromkeys({r[0] for r in rows}, (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())) | expected(harmed(rows))
    result = queries.op13_conversation_repair(spark, SF)
    assert {r["conv_id"]: tuple(r)[1:] for r in result.collect()} == want
