"""Conversation structure repair by rank-convergence parallel Viterbi.

A repaired conversation reads ``(s?(ua)+)?`` by the initials of its roles. Rows are kept,
given another role, or deleted, and empty turns are inserted, at the least cost; of the
cheapest repairs the one whose audit (the edits' initials) comes first is taken.

The states of the pattern are 0 (nothing yet), 1 (after s), 2 (after u) and 3 (after a).
A vector holds, for each state before a row, the least cost to the conversation's end.
Vectors are found backward, from row to row, and steer the audit forward: a step is on a
cheapest path where its cost and the next vector's add up to this one's.

Rows are range-partitioned by conversation and turn and cut into chunks of bounded
size, so that a conversation may spread over any number of tasks. Most conversations
are one chunk, whose vectors start from the true end. The chunks of the others start
from a speculative vector, the one at a conversation's end. In fix-up passes a chunk
takes the vector that its successor now begins with and runs on from its end until the
old and the new vector differ by a constant only; from there on, old differences hold,
and differences are all that the audit needs. Passes go over tiles of chunks that grow
eightfold, and end when no chunk's incoming vector changes. The chunks' maps from state
to state are composed by doubling, which gives each chunk its first state.

A text seen earlier in its conversation is looked up among the first ones of other
tasks by a 128-bit digest of role and text. Rows that repeat whole are counted before
the first shuffle.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import checkpointed, stored

CHUNK_ROWS = 4096
CHUNK_CHARS = 4 << 20
TILE_GROWTH = 8
ROWS_PER_BATCH = 1024
#: Characters of a text that help to place a row among those of the same turn and role.
PREFIX = 64

# Costs, states and the damage.
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 2, 1, 5, 5
NEXT = (2, 2, 3, 2)
ROLE_OF = {2: "user", 3: "assistant"}
ACCEPTED_PAIRS = frozenset(("su", "ua", "au"))
WHITE_SPACE = " \t\n\v\f\r"
KINDS = {"s": 1, "u": 2, "a": 3}
TRUNCATED, DELETE_ONLY = 4, 8

Vector = tuple[int, int, int, int]


# -- one row's step --------------------------------------------------------------------


def _inserted(v: Vector) -> Vector:
    """``v`` with turns inserted where that is cheaper, its least cost taken off."""
    second, third = min(v[2], INSERT_COST + v[3]), min(v[3], INSERT_COST + v[2])
    whole = (min(v[0], INSERT_COST + second), min(v[1], INSERT_COST + second), second, third)
    least = min(whole)
    return tuple(c - least for c in whole)


#: The vector at a conversation's end: nothing or an assistant's turn may come last.
END = _inserted((0, 4 * INSERT_COST, 4 * INSERT_COST, 0))


def _moves(code: int, state: int, after: Vector) -> list[tuple[int, str, int]]:
    """(cost to the end, edit, next state) of what can be done with a row, in the order of edits."""
    found = [(DELETE_COST + after[state], "D", state)]
    if code != DELETE_ONLY:
        kind, extra = code & 3, TRUNCATED_COST if code & TRUNCATED else 0
        if kind == 1 and state == 0:
            found.append((extra + after[1], "K", 1))
        to = NEXT[state]
        found.append((extra + after[to], "K", to) if kind == to else (REROLE_COST + extra + after[to], "R", to))
    return found


@functools.cache
def before_row(code: int, after: Vector) -> Vector:
    """The vector before a row, from the one after it; both have a least cost of 0."""
    return _inserted(tuple(min(_moves(code, state, after))[0] for state in range(4)))


@functools.cache
def step(code: int, after: Vector) -> tuple[tuple[str, int, int], ...]:
    """Per state before a row: the first of the cheapest edits up to and with the row, the next state, their cost."""
    direct = [_moves(code, state, after) for state in range(4)]
    best = [min(moves)[0] for moves in direct]

    def chosen(state: int, may_insert: int = 2) -> tuple[int, str, int]:
        deleted = direct[state][0]
        options = [(deleted[0], "D", state)]
        if may_insert:
            cost, edits, to = chosen(NEXT[state], may_insert - 1)
            options.append((INSERT_COST + cost, f"I{edits}", to))
        options += [m for m in direct[state][1:] if m[0] == best[state]]
        return min(options)

    found = []
    for state in range(4):
        cost, edits, to = chosen(state)
        found.append((edits, to, cost - after[to]))
    return tuple(found)


def before_chunk(codes: bytes, after: Vector) -> Vector:
    for code in reversed(codes):
        after = before_row(code, after)
    return after


def refixed(codes: bytes, old: Vector, new: Vector, old_out: Vector) -> Vector:
    """The vector before a chunk whose incoming vector was ``old`` and gave ``old_out``, for ``new``."""
    for code in reversed(codes):
        if old == new:
            return old_out
        old, new = before_row(code, old), before_row(code, new)
    return new


def traced(codes: bytes, after: Vector, state: int) -> tuple[list[str], int, int]:
    """(edits of each row, last state, cost) from ``state``, with the vector behind the chunk."""
    vectors = [after]
    for code in reversed(codes):
        vectors.append(before_row(code, vectors[-1]))
    edits, cost = [], 0
    for i, code in enumerate(codes):
        done, state, paid = step(code, vectors[len(codes) - 1 - i])[state]
        edits.append(done)
        cost += paid
    return edits, state, cost


def end_states(codes: bytes, after: Vector) -> list[int]:
    """The last state for each first state."""
    vectors = [after]
    for code in reversed(codes):
        vectors.append(before_row(code, vectors[-1]))
    states = [0, 1, 2, 3]
    for i, code in enumerate(codes):
        steps = step(code, vectors[len(codes) - 1 - i])
        states = [steps[s][1] for s in states]
        if len(set(states)) == 1:
            return [traced(codes[i + 1 :], after, states[0])[1]] * 4
    return states


_solved = functools.lru_cache(1 << 14)(lambda codes: traced(codes, END, 0))


# -- chunks ----------------------------------------------------------------------------

_STATS = ["n_turns", "min_turn", "max_turn", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal"]
_CHUNK = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("whole", pa.bool_())]
    + [(name, pa.int64()) for name in _STATS]
    + [("first_initial", pa.string()), ("last_initial", pa.string()), ("codes", pa.binary())]
    + [("keys", pa.list_(pa.binary())), ("times", pa.list_(pa.int64()))]
    + [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
)
_SQL_TYPES = {
    pa.int64(): "bigint", pa.int32(): "int", pa.bool_(): "boolean", pa.string(): "string", pa.binary(): "binary",
    pa.list_(pa.binary()): "array<binary>", pa.list_(pa.int64()): "array<bigint>", pa.list_(pa.string()): "array<string>",
}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SQL_TYPES[f.type]}" for f in schema)


def _batches(rows: Iterator[dict], schema: pa.Schema, at_once: int = ROWS_PER_BATCH) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(map(len, row.get("texts") or ()))
        if len(held) >= at_once or size >= CHUNK_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def row_code(role: str, text: str) -> int:
    """How a row looks by itself: its initial's kind and whether it is truncated; blank rows may only go."""
    said = text.rstrip(WHITE_SPACE)
    if not said.lstrip(WHITE_SPACE):
        return DELETE_ONLY
    return KINDS.get(role[:1], 0) | (0 if said[-1] in ".!?" else TRUNCATED)


class _Chunk:
    """The chunk of one conversation that is being filled."""

    def __init__(self, conv_id: int | None, seq: int):
        self.conv_id, self.seq, self.size = conv_id, seq, 0
        self.stats = dict.fromkeys(_STATS, 0) | dict.fromkeys(["min_turn", "max_turn", "first_turn", "last_turn"])
        self.first_initial = self.last_initial = None
        self.codes, self.keys, self.times = bytearray(), [], []
        self.roles, self.texts = [], []

    def add(self, turn: int | None, role: str, text: str, times: int, code: int, key: bytes | None) -> None:
        s, initial = self.stats, role[:1]
        if turn is not None:
            s["n_turns"] += turn != s["last_turn"]
            s["min_turn"], s["max_turn"] = turn if s["min_turn"] is None else s["min_turn"], turn
            s["first_turn"], s["last_turn"] = s["min_turn"], turn
        if self.last_initial is None:
            self.first_initial = initial
        else:
            s["illegal"] += self.last_initial + initial not in ACCEPTED_PAIRS
        s["illegal"] += times - 1
        self.last_initial = initial
        blank, first = key is None, code != DELETE_ONLY
        s["blank"] += times if blank else 0
        s["duplicate"] += 0 if blank else times - first
        s["truncated"] += first and bool(code & TRUNCATED)
        self.codes.append(code)
        self.keys.append(key if first else None)
        self.times.append(times)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)

    def row(self, part: int, whole: bool) -> dict:
        return self.stats | {
            "conv_id": self.conv_id, "part": part, "seq": self.seq, "whole": whole,
            "first_initial": self.first_initial, "last_initial": self.last_initial,
            "codes": bytes(self.codes), "keys": None if whole else self.keys, "times": self.times,
            "roles": self.roles, "texts": self.texts,
        }


def _cut(rows: Iterator[tuple], part: int, chunk_rows: int) -> Iterator[dict]:
    """Chunks of rows (conv_id, turn, role, text, times) in order.

    A chunk is whole where it holds its conversation and rows of others lie on both sides.
    """
    chunk, seq, seen, first, cut = None, 0, set(), True, False
    for conv_id, turn, role, text, times in rows:
        if chunk is not None and chunk.conv_id != conv_id:
            yield chunk.row(part, whole=not first and not cut)
            chunk, seen, first, cut = None, set(), False, False
        elif chunk is not None and (len(chunk.codes) >= chunk_rows or chunk.size >= CHUNK_CHARS):
            yield chunk.row(part, whole=False)
            chunk, cut = None, True
        if chunk is None:
            chunk, seq = _Chunk(conv_id, seq), seq + 1
        if role is None:
            continue
        code, key = row_code(role, text), None
        if code != DELETE_ONLY:
            name = f"{len(role)}:{role}{text}".encode()
            key = hashlib.blake2b(name, digest_size=16).digest()
            if key in seen:
                code = DELETE_ONLY
            seen.add(key)
        chunk.add(turn, role, text, times, code, key)
    if chunk is not None:
        yield chunk.row(part, whole=False)


def chunks(turns: DataFrame, dropped: Column | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Chunks of the conversations of ``turns`` (conv_id, turn, role, text), in order by (part, seq).

    Rows where ``dropped`` holds only say that their conversation is there. The table is
    written to the checkpoint folder, split by ``whole``.
    """
    gone = F.lit(False) if dropped is None else dropped
    value = lambda c: F.when(~gone, c)
    rows = turns.select(
        F.col("conv_id").cast("bigint"),
        value(F.col("turn").cast("bigint")).alias("turn"),
        value(F.coalesce("role", F.lit(" "))).alias("role"),
        value(F.coalesce("text", F.lit(" "))).alias("text"),
    )
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times"))
    placed = counted.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, PREFIX))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        return _batches(_cut(rows, TaskContext.get().partitionId(), chunk_rows), _CHUNK)

    return stored(
        placed.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(cut, _ddl(_CHUNK)), partition_by=["whole"]
    )


# -- conversations of several chunks ---------------------------------------------------


def _late_duplicates(parts: DataFrame) -> DataFrame:
    """(part, seq, late): the rows of a chunk whose text an earlier task's rows of the conversation hold."""
    keys = parts.select("who", "part", "seq", F.posexplode("keys").alias("at", "key")).where("key IS NOT NULL")
    first = keys.groupBy("who", "key").agg(F.min("part").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        keys.join(first, ["who", "key"])
        .where("part > first")
        .groupBy("part", "seq")
        .agg(F.collect_list("at").alias("late"))
    )


_LINK = pa.schema(
    [("who", pa.string()), ("k", pa.int64()), ("codes", pa.binary()), ("used", pa.list_(pa.int64())), ("out", pa.list_(pa.int64()))]
)


def _fix(rows: Iterator[tuple]) -> Iterator[dict]:
    """Chunks (who, k, codes, used, out, incoming, tile), backward within tiles, with vectors brought up to date."""
    last, fresh = None, None
    for who, k, codes, used, out, incoming, tile in rows:
        used, new = tuple(used), fresh if last == (who, tile, k + 1) else tuple(incoming)
        out = before_chunk(codes, new) if out is None else refixed(codes, used, new, tuple(out))
        last, fresh = (who, tile, k), out
        yield {"who": who, "k": k, "codes": codes, "used": list(new), "out": list(out)}


def linked_vectors(links: DataFrame, growth: int = TILE_GROWTH) -> DataFrame:
    """(who, k, codes, used, out) of chunks (who, k, codes): the true vectors behind and before each, by passes."""
    vector = F.array(*[F.lit(c).cast("bigint") for c in END])

    def fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        return _batches(_fix(rows), _LINK)

    # The speculative pass: every chunk by itself.
    guess = links.select(
        "who", "k", "codes", vector.alias("used"), F.lit(None).cast("array<bigint>").alias("out"),
        vector.alias("incoming"), F.col("k").alias("tile"),
    )
    found, tile = checkpointed(guess.mapInArrow(fix, _ddl(_LINK))), 1
    while True:
        behind = found.select("who", (F.col("k") - 1).alias("k"), F.col("out").alias("incoming"))
        met = found.join(behind, ["who", "k"], "left").withColumn("incoming", F.coalesce("incoming", vector))
        if met.where("incoming != used").isEmpty():
            return found
        tile *= growth
        passed = met.withColumn("tile", F.floor(F.col("k") / F.lit(tile))).repartition("who", "tile")
        found = checkpointed(
            passed.sortWithinPartitions("who", "tile", F.desc("k"))
            .select("who", "k", "codes", "used", "out", "incoming", "tile")
            .mapInArrow(fix, _ddl(_LINK))
        )


def first_states(vectors: DataFrame) -> DataFrame:
    """(who, k, used, state): the state before each chunk, by doubling the chunks' maps of states."""
    schema = pa.schema([("who", pa.string()), ("k", pa.int64()), ("used", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield from _batches(
                ({"who": w, "k": k, "used": used, "ends": end_states(codes, tuple(used))} for w, k, codes, used in rows), schema
            )

    maps = checkpointed(vectors.select("who", "k", "codes", "used").mapInArrow(mapped, _ddl(schema)))
    # ``ends`` goes from the state before chunk max(1, k - reach + 1) to the one behind chunk k.
    reach, longest = 1, maps.agg(F.max("k")).first()[0] or 0
    while reach < longest:
        earlier = maps.select("who", (F.col("k") + reach).alias("k"), F.col("ends").alias("before"))
        composed = F.transform("before", lambda s: F.col("ends")[s.cast("int")])
        maps = checkpointed(
            maps.join(earlier, ["who", "k"], "left").select("who", "k", "used", F.coalesce(composed, "ends").alias("ends"))
        )
        reach *= 2
    behind = maps.select("who", (F.col("k") + 1).alias("k"), F.col("ends")[0].alias("state"))
    return maps.join(behind, ["who", "k"], "left").select("who", "k", "used", F.coalesce("state", F.lit(0)).alias("state"))


# -- repair ----------------------------------------------------------------------------

_REPAIRED = pa.schema(
    [_CHUNK.field(n) for n in ("conv_id", "part", "seq", *_STATS, "first_initial", "last_initial")]
    + [("cost", pa.int64()), ("audit", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
)
_WITH_PLACE = ["late", "used", "state", "last"]


class _Place(NamedTuple):
    late: list[int]
    used: Vector
    state: int
    last: bool


def _repaired(row: dict, place: _Place | None) -> dict:
    """A chunk's repair: edits, cost, and the rows that it leaves. Without a place it is a whole conversation."""
    codes, late = bytearray(row["codes"]), place.late if place else []
    found = {n: row[n] for n in _REPAIRED.names if n in row}
    for at in late:
        found["duplicate"] += 1
        found["truncated"] -= bool(codes[at] & TRUNCATED)
        codes[at] = DELETE_ONLY
    state = place.state if place else 0
    edits, end, cost = traced(bytes(codes), place.used, state) if place else _solved(bytes(codes))
    roles, texts, audit = [], [], []
    for done, role, text, times in zip(edits, row["roles"], row["texts"], row["times"], strict=True):
        for edit in done:
            if edit != "D":
                state = 1 if edit == "K" and role[:1] == "s" else NEXT[state]
                roles.append(role if edit == "K" else ROLE_OF[state])
                texts.append("" if edit == "I" else text)
        audit.append(done + "D" * (times - 1))
        cost += DELETE_COST * (times - 1)
    if place is None or place.last:
        while end in (1, 2):
            end = NEXT[end]
            audit.append("I")
            cost += INSERT_COST
            roles.append(ROLE_OF[end])
            texts.append("")
    return found | {"cost": cost, "audit": "".join(audit), "roles": roles, "texts": texts}


def repair(turns: DataFrame, dropped: Column | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Repaired chunks of the conversations of ``turns`` (conv_id, turn, role, text).

    In order by (part, seq), a conversation's chunks give its repaired ``roles`` and
    ``texts``, its ``audit``, and counts of what was found. ``whole`` says that the
    chunk is a conversation by itself.

    Rows are taken by turn, nulls first, then role and text. A null role or text is one
    space. Null conv_ids are one conversation. Rows where ``dropped`` holds are left
    out, but their conversation has a chunk at least. Other columns are not used; an
    empty table gives no rows.
    """
    cut = chunks(turns, dropped, chunk_rows)
    columns = [n for n in _CHUNK.names if n not in ("whole", "keys")]

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for lo in range(0, batch.num_rows, ROWS_PER_BATCH):
                    for row in batch.slice(lo, ROWS_PER_BATCH).to_pylist():
                        place = None
                        if "used" in row:
                            place = _Place(row["late"] or [], tuple(row["used"]), row["state"], row["last"])
                        yield _repaired(row, place)

        return _batches(rows(), _REPAIRED)

    alone = cut.where("whole").select(*columns).mapInArrow(mend, _ddl(_REPAIRED))

    who = F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("who")
    parts = cut.where("NOT whole").select(who, "part", "seq", "codes", "keys")
    order = Window.partitionBy("who").orderBy("part", "seq")
    late = checkpointed(_late_duplicates(parts))
    numbered = checkpointed(
        parts.select("who", "part", "seq", F.row_number().over(order).alias("k"))
        .withColumn("last", F.col("k") == F.max("k").over(Window.partitionBy("who")))
        .join(late, ["part", "seq"], "left")
    )
    schema = pa.schema([("who", pa.string()), ("k", pa.int64()), ("codes", pa.binary())])

    def corrected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for row in batch.to_pylist():
                    codes = bytearray(row["codes"])
                    for at in row["late"] or []:
                        codes[at] = DELETE_ONLY
                    yield {"who": row["who"], "k": row["k"], "codes": bytes(codes)}

        return _batches(rows(), schema)

    links = (
        parts.select("part", "seq", "codes")
        .join(numbered.select("who", "k", "part", "seq", "late"), ["part", "seq"])
        .mapInArrow(corrected, _ddl(schema))
    )
    states = first_states(linked_vectors(links))
    places = numbered.join(states, ["who", "k"]).select("part", "seq", *_WITH_PLACE)
    spread = (
        cut.where("NOT whole").select(*columns).join(places, ["part", "seq"]).select(*columns, *_WITH_PLACE)
        .mapInArrow(mend, _ddl(_REPAIRED))
    )
    return alone.withColumn("whole", F.lit(True)).union(spread.withColumn("whole", F.lit(False)))


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """The rows of repaired conversations: conv_id, part, seq, at (in order by these), role, text."""
    rows = F.posexplode(F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text"))).alias("at", "row")
    return repaired.select("conv_id", "part", "seq", rows).select("conv_id", "part", "seq", "at", "row.role", "row.text")


_REPORT = pa.schema(
    [(n, pa.int64()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)


def _stitched(rows: Iterator[dict]) -> Iterator[dict]:
    """One row per conversation, from its chunks in order. Texts are hashed as they pass."""
    total, digest, audit, began = None, None, [], False

    def finished() -> dict:
        gaps = 0 if total["min_turn"] is None else total["max_turn"] - total["min_turn"] + 1 - total["n_turns"]
        return {n: total[n] for n in _REPORT.names if n in total} | {
            "gaps": gaps, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()
        }

    for row in rows:
        if total is None or total["conv_id"] != row["conv_id"]:
            if total is not None:
                yield finished()
            total, digest, audit, began = dict(row), hashlib.sha256(), [], False
        else:
            both = None not in (total["last_turn"], row["first_turn"])
            total["n_turns"] += row["n_turns"] - (both and total["last_turn"] == row["first_turn"])
            for name, pick in (("min_turn", min), ("max_turn", max)):
                known = [v for v in (total[name], row[name]) if v is not None]
                total[name] = pick(known) if known else None
            if None not in (total["last_initial"], row["first_initial"]):
                total["illegal"] += total["last_initial"] + row["first_initial"] not in ACCEPTED_PAIRS
            for name in ("blank", "duplicate", "truncated", "illegal", "cost"):
                total[name] += row[name]
            for name in ("last_turn", "last_initial"):
                total[name] = total[name] if row[name] is None else row[name]
        audit.append(row["audit"])
        for role, text in zip(row["roles"], row["texts"], strict=True):
            digest.update(f"{'\n' if began else ''}{role}:{text}".encode())
            began = True
    if total is not None:
        yield finished()


def report(repaired: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, cost, audit and the repaired text's digest.

    Whole conversations stay where they are. The chunks of others pass through one task
    each in order, as a digest goes from beginning to end; a chunk at a time is held.
    """

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row
            for batch in batches
            for lo in range(0, batch.num_rows, ROWS_PER_BATCH)
            for row in batch.slice(lo, ROWS_PER_BATCH).to_pylist()
        )
        return _batches(_stitched(rows), _REPORT)

    spread = repaired.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return repaired.where("whole").mapInArrow(stitch, _ddl(_REPORT)).union(spread.mapInArrow(stitch, _ddl(_REPORT)))


# -- damage ----------------------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) damaged by the checksum of their place, with ``dropped``."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = name("text")
    return (
        turns.select(
            "conv_id",
            "turn",
            F.when(harm == 4, "user").otherwise(name("role")).alias("role"),
            F.when(harm == 1, "").when(harm == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            harm.alias("harm"),
        )
        .withColumn("copy", F.explode(F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .select("conv_id", "turn", "role", "text", (F.col("harm") == 0).alias("dropped"))
    )
