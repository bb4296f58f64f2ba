"""Conversation structure repair: the cheapest edits that make a conversation ``(s?(ua)+)?``, ties to the least audit.

A conversation is read row by row by an automaton over role initials with four states: nothing yet, after ``s``, after
``u``, after ``a``. Each row is an edge between two states: up to two inserts, then keep, rerole or delete. An edge's
weight is one integer: its cost in the high digits, its letters in a slot of three octal digits that only this row has,
padded with zeros at the slot's end. The minimum over the DAG of (row, state) is then an ordinary integer minimum, and
the edits are read from the digits of the result. This is exact since no two different letter strings of one row are
prefixes of one another: both end in their only letter that is not an insert.

Rows that must go (blank, repeated) are no part of the DAG: a delete changes no state, and ``D`` sorts before ``I``, so no
insert ever stands directly before a delete.

No conversation is collected. Rows are numbered by a range sort on narrow columns, so a long conversation lies in many
partitions. Every 64 neighbouring numbers of a conversation make a block, whose 16 minima (first to last state) are taken
by the same DP; the letters of a block are replaced by their rank among the 16, which is again one digit. Blocks are put
together in the same way until a conversation has at most ``FINAL`` of them, and the chosen states go back down.

Order within a conversation: turn (nulls first), role, then the hexadecimal SHA-256 of the text. Rows equal in all of
these are copies: one row with a count. Texts are compared by SHA-256. A null role or text is read as one space; a null
conversation id is a conversation of its own. A role without a first character cannot be kept, only reroled or deleted.
Empty and very long texts need no special case: texts take part by hash, first and last character only. Extra columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillhouse.llm.frames import appended, stored

# Costs of edits, white space, and what ends a sentence.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
SPACE = " \t\n\x0b\x0c\r"
ENDS = [".", "!", "?"]

#: Rows or blocks that make one block (as a power of two), and blocks of a conversation that are put together at once.
BLOCK_BITS, FINAL = 6, 1024

START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = range(4)
_LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
_NAMES = {number: letter for letter, number in _LETTERS.items()}
_SLOT = 9  # bits of three letters
_RANK = 5  # bits of a rank among 16
#: What an inserted or reroled row may be after each state, and how a conversation may end from it.
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

Edge = tuple[int, int]  # cost, digits
Matrix = tuple[tuple[Edge | None, ...], ...]  # by first and last state


def _slot(letters: str) -> int:
    number = 0
    for letter in letters.ljust(3, "0"):
        number = 8 * number + _LETTERS.get(letter, 0)
    return number


def _letters(slot: int) -> str:
    return "".join(_NAMES[d] for d in (slot >> 6, slot >> 3 & 7, slot & 7) if d)


@lru_cache(maxsize=None)  # eight codes
def row_matrix(code: str) -> Matrix:
    """The edges of one row. ``code`` is its role initial (s, u, a, or x for others), in upper case if truncated."""
    initial, fee = code.lower(), TRUNCATED if code.isupper() else 0
    out: list[list[Edge | None]] = [[None] * 4 for _ in _STATES]

    def offer(first: int, last: int, cost: int, letters: str) -> None:
        edge, now = (cost, _slot(letters)), out[first][last]
        out[first][last] = edge if now is None else min(now, edge)

    for first in _STATES:
        offer(first, first, DELETE, "D")
        state = first
        for inserts in range(3):
            paid = INSERT * inserts + fee
            offer(first, _NEXT[state], paid + REROLE, "I" * inserts + "R")
            if initial == "s" and state == START:
                offer(first, SYSTEM, paid, "I" * inserts + "K")
            elif initial == {USER: "u", ASSISTANT: "a"}[_NEXT[state]]:
                offer(first, _NEXT[state], paid, "I" * inserts + "K")
            state = _NEXT[state]
    return tuple(tuple(row) for row in out)


def chain(units: list[Matrix], first: int, width: int) -> dict[int, int]:
    """The least integer for each state that can be reached from ``first``: cost above, one digit per unit below."""
    high = width * len(units)
    best, low = {first: 0}, high
    for unit in units:
        low -= width
        after: dict[int, int] = {}
        for state, value in best.items():
            for last, edge in enumerate(unit[state]):
                if edge is not None:
                    number = value + (edge[0] << high) + (edge[1] << low)
                    if last not in after or number < after[last]:
                        after[last] = number
        best = after
    return best


def _digits(value: int, n: int, width: int) -> list[int]:
    return [value >> width * (n - 1 - k) & (1 << width) - 1 for k in range(n)]


def whole_matrix(units: list[Matrix], width: int) -> Matrix:
    """All units as one: its digits are ranks among the audits that occur, from 1 on."""
    high = width * len(units)
    best = [chain(units, first, width) for first in _STATES]
    audits = sorted({value & (1 << high) - 1 for row in best for value in row.values()})
    rank = {audit: k + 1 for k, audit in enumerate(audits)}
    return tuple(
        tuple((row[q] >> high, rank[row[q] & (1 << high) - 1]) if q in row else None for q in _STATES) for row in best
    )


def states_along(units: list[Matrix], first: int, digits: list[int]) -> list[int]:
    """The state after each unit, on the path from ``first`` with these digits."""
    out = []
    for unit, digit in zip(units, digits):
        first = next(q for q in _STATES if unit[first][q] is not None and unit[first][q][1] == digit)
        out.append(first)
    return out


def closed(units: list[Matrix], width: int) -> tuple[int, list[int], str]:
    """The cheapest way from the start through all units to a legal end: cost, digits, and the inserts at the end."""
    high = width * len(units)
    ends = [
        ((value << _SLOT) + (INSERT * len(_CLOSING[q]) << high + _SLOT) + _slot(_CLOSING[q]), q)
        for q, value in chain(units, START, width).items()
    ]
    value, last = min(ends)
    return value >> high + _SLOT, _digits(value >> _SLOT, len(units), width), _CLOSING[last]


@lru_cache(maxsize=1 << 14)  # at most 64 characters each
def codes_matrix(codes: str) -> Matrix:
    return whole_matrix([row_matrix(c) for c in codes], _SLOT)


@lru_cache(maxsize=1 << 14)
def codes_letters(codes: str, first: int, last: int) -> tuple[tuple[str, ...], tuple[int, ...]]:
    """The letters of each row on the best path between two states, and the state before each row."""
    units = [row_matrix(c) for c in codes]
    digits = _digits(chain(units, first, _SLOT)[last], len(units), _SLOT)
    before = [first, *states_along(units, first, digits)[:-1]]
    return tuple(_letters(d) for d in digits), tuple(before)


# -- Frames


def damaged(conversations: DataFrame) -> DataFrame:
    """Test damage by ``crc32(conv_id:turn) % 20`` (nulls: one space): rows dropped, emptied, cut, repeated, reroled."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", known("conv_id"), known("turn"))) % 20
    body = F.when(kind == 1, "").when(kind == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    role = F.when(kind == 4, "user").otherwise(known("role"))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.where(kind != 0).select("conv_id", "turn", role.alias("role"), body.alias("text"), times.alias("times"))
    return rows.withColumn("times", F.explode("times")).drop("times")


def _known(rows: DataFrame) -> DataFrame:
    """The four columns without null roles and texts, and ``row_key``, one hash of all four."""
    rows = rows.select("conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    part = lambda c: F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("null"))
    rows = rows.withColumn("text_key", F.sha2("text", 256))
    key = F.concat_ws(" ", "text_key", part("role"), part("turn"), part("conv_id"))
    return rows.withColumn("row_key", F.unhex(F.sha2(key, 256)))


def places(rows: DataFrame) -> DataFrame:
    """One narrow row per different row, with ``copies``, its first fault and its number ``place`` in the order of rows."""
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    narrow = _known(rows).select("conv_id", "turn", "role", "text_key", "row_key", last.alias("last"))
    narrow = narrow.groupBy(*narrow.columns).agg(F.count("*").alias("copies"))
    order = ["conv_id", "turn", "role", "text_key"]
    numbered = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(numbered.withColumn("place", F.monotonically_increasing_id()), "repair-places")
    firsts = numbered.where("last <> ''").groupBy("conv_id", "role", "text_key").agg(F.min("place").alias("place"))
    found = numbered.join(firsts.select("place", F.lit(True).alias("fresh")), "place", "left")
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    truncated = ~F.col("last").isin(ENDS)
    fault = F.when(F.col("last") == "", "blank").when(F.col("fresh").isNull(), "duplicate").when(truncated, "truncated")
    code = F.when(F.col("fresh"), F.when(truncated, F.upper(initial)).otherwise(initial))
    return stored(
        found.select("conv_id", "turn", "role", "row_key", "copies", "place", fault.alias("fault"), code.alias("code")), "repair-faults"
    )


def _flat(matrix: Matrix) -> tuple[list[int | None], list[int | None]]:
    edges = [edge for row in matrix for edge in row]
    return [e and e[0] for e in edges], [e and e[1] for e in edges]


def _matrix(costs: list[int | None], ranks: list[int | None]) -> Matrix:
    edges = [None if c is None else (c, r) for c, r in zip(costs, ranks)]
    return tuple(tuple(edges[4 * p : 4 * p + 4]) for p in _STATES)


def _with_matrix(units: DataFrame, column: str, whole) -> DataFrame:
    """``units`` with the costs and ranks of ``whole`` of a column."""

    def start():
        def work(batch: pa.RecordBatch) -> list:
            both = [_flat(whole(value)) for value in batch.column(column).to_pylist()]
            return [pa.array([b[0] for b in both], pa.list_(pa.int64())), pa.array([b[1] for b in both], pa.list_(pa.int32()))]

        return work

    return appended(units, units.columns, [("costs", "array<bigint>"), ("ranks", "array<int>")], start)


def _parts(value: list[dict]) -> list[Matrix]:
    return [_matrix(u["costs"], u["ranks"]) for u in value]


def _expanded(frame: DataFrame, kind: str, spread, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per struct of the list ``spread(row)``, next to the columns ``carry``."""

    def start():
        def work(batch: pa.RecordBatch) -> list:
            return [pa.array([spread(row) for row in batch.to_pylist()], pa.list_(_arrow(kind)))]

        return work

    return appended(frame, list(carry), [("out", f"array<struct<{kind}>>")], start).select(*carry, F.inline("out"))


def _arrow(kind: str) -> pa.DataType:
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.struct([(name, types[t]) for name, t in (field.split(":") for field in kind.split(","))])


def edits(found: DataFrame, bits: int = BLOCK_BITS, final: int = FINAL) -> tuple[DataFrame, DataFrame]:
    """From :func:`places`: the letters of each row that may stay, and those that close a conversation.

    The first frame has (place, letters, before), the second (conv_id, letters, before); ``before`` is the state in which
    the letters are met.
    """
    live = found.where("code is not null").select("conv_id", "place", "code", F.shiftright("place", bits).alias("block"))
    units = live.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("place", "code"))).alias("steps"))
    units = units.withColumns({"unit": F.col("steps")[0]["place"], "codes": F.array_join(F.col("steps.code"), "")})
    levels = [stored(_with_matrix(units, "codes", codes_matrix), "repair-blocks")]
    child = F.sort_array(F.collect_list(F.struct("unit", "costs", "ranks"))).alias("parts")
    while True:
        top = levels[-1]
        if (top.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0) <= final:
            break
        up = top.groupBy("conv_id", F.shiftright("block", bits).alias("block")).agg(child)
        up = up.withColumn("unit", F.col("parts")[0]["unit"])
        levels.append(stored(_with_matrix(up, "parts", lambda value: whole_matrix(_parts(value), _RANK)), "repair-blocks"))

    def routed(units: list[dict], digits: list[int], first: int) -> list[dict]:
        after = states_along(_parts(units), first, digits)
        return [{"unit": u["unit"], "first": p, "last": q} for u, p, q in zip(units, [first, *after[:-1]], after)]

    def from_top(row: dict) -> list[dict]:
        _, digits, closing = closed(_parts(row["parts"]), _RANK)
        out = routed(row["parts"], digits, START)
        return out + [{"first": out[-1]["last"], "closing": closing}] * bool(closing)

    def from_level(row: dict) -> list[dict]:
        units = _parts(row["parts"])
        value = chain(units, row["first"], _RANK)[row["last"]]
        return routed(row["parts"], _digits(value, len(units), _RANK), row["first"])

    def from_block(row: dict) -> list[dict]:
        letters, before = codes_letters(row["codes"], row["first"], row["last"])
        return [{"place": s["place"], "letters": x, "before": b} for s, x, b in zip(row["steps"], letters, before)]

    path = _expanded(top.groupBy("conv_id").agg(child), "unit:bigint,first:int,last:int,closing:string", from_top, ("conv_id",))
    path = stored(path, "repair-path")
    closing = path.where("closing is not null").select("conv_id", F.col("closing").alias("letters"), F.col("first").alias("before"))
    path = path.where("closing is null").select("unit", "first", "last")
    for level in reversed(levels[1:]):
        path = _expanded(level.select("unit", "parts").join(path, "unit"), "unit:bigint,first:int,last:int", from_level)
        path = stored(path, "repair-path")
    chosen = levels[0].select("unit", "steps", "codes").join(path, "unit")
    return _expanded(chosen, "place:bigint,letters:string,before:int", from_block), closing


def edited(rows: DataFrame, bits: int = BLOCK_BITS, final: int = FINAL) -> DataFrame:
    """Every different row of ``rows`` with what is done to it, in the order ``(closing, place)`` within a conversation.

    Columns: conv_id, closing, place, turn, role, text, copies, fault (blank, duplicate, truncated or null), letters (of
    the first copy; further copies are deleted) and before (the state in which it is met). The inserts that close a
    conversation are a row with ``closing`` true and neither place nor turn.
    """
    found = places(rows)
    chosen, ends = edits(found, bits, final)
    texts = _known(rows).groupBy("row_key").agg(F.first("text").alias("text"))
    main = found.join(chosen, "place", "left").join(texts, "row_key", "left").drop("row_key", "code")
    main = main.withColumns({"letters": F.coalesce("letters", F.lit("D")), "closing": F.lit(False)})
    ends = ends.withColumns({"closing": F.lit(True), "copies": F.lit(0).cast("bigint")})
    main = main.unionByName(ends, allowMissingColumns=True)
    return main.select("conv_id", "closing", "place", "turn", "role", "text", "copies", "fault", "letters", "before")


_ROLE = {USER: "user", ASSISTANT: "assistant"}


def resulting(letters: str, state: int, role: str | None, text: str | None) -> tuple[list[tuple[str, str]], int]:
    """The rows that letters leave when met in ``state``, and the state after them."""
    out = []
    for letter in letters:
        if letter == "K":
            out.append((role, text))
            state = SYSTEM if state == START and role.startswith("s") else _NEXT[state]
        elif letter != "D":
            state = _NEXT[state]
            out.append((_ROLE[state], "" if letter == "I" else text))
    return out, state


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, closing, place, part, role, text, in the order (closing, place, part)."""

    def spread(row: dict) -> list[dict]:
        left, _ = resulting(row["letters"], row["before"], row["role"], row["text"])
        return [{"part": k, "role": role, "text": text} for k, (role, text) in enumerate(left)]

    kept = edited(rows).where("letters <> 'D'")
    return _expanded(kept, "part:int,role:string,text:string", spread, ("conv_id", "closing", "place"))


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_LEGAL = {"su", "ua", "au"}
_PRICE = {"D": DELETE, "R": REROLE, "I": INSERT, "K": 0}


class _Report:
    """Counts and digests of one conversation, row after row."""

    def __init__(self, conv):
        self.conv, self.low, self.high, self.turns, self.turn = conv, None, None, 0, None
        self.count = dict.fromkeys(_COUNTS, 0)
        self.audit: list[str] = []
        self.digest, self.state, self.initial, self.any = hashlib.sha256(), START, None, False

    def add(self, row: dict) -> None:
        letters, copies, fault, role = row["letters"], row["copies"], row["fault"], row["role"]
        if letters is None:  # a mark: this conversation was there
            return
        if not row["closing"]:
            turn, count = row["turn"], self.count
            if turn is not None and turn != self.turn:
                self.low = turn if self.low is None else self.low
                self.high, self.turn, self.turns = turn, turn, self.turns + 1
            if fault in ("blank", "duplicate"):
                count[fault] += copies
            else:
                count["truncated"] += fault is not None
                count["duplicate"] += copies - 1
            initial = role[:1]
            count["illegal"] += (self.initial is not None and self.initial + initial not in _LEGAL) + copies - 1
            self.initial = initial
            count["cost"] += DELETE * (copies - 1) + (TRUNCATED if fault == "truncated" and "D" not in letters else 0)
        self.count["cost"] += sum(_PRICE[x] for x in letters)
        self.audit.append(letters + "D" * max(0, copies - 1))
        left, self.state = resulting(letters, self.state, role, row["text"])
        for role, text in left:
            self.digest.update((f"\n{role}:{text}" if self.any else f"{role}:{text}").encode())
            self.any = True

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, *(self.count | {"gaps": gaps}).values(), "".join(self.audit), self.digest.hexdigest())


def report(done: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``: counts, cost, audit and the SHA-256 of what :func:`edited` leaves.

    The digest of a conversation is sequential, so its rows pass through one task, sorted, one Arrow batch at a time;
    nothing of them is held but the audit, which is part of the result.
    """
    fields = [StructField("conv_id", conversations.schema["conv_id"].dataType)]
    fields += [StructField(c, LongType()) for c in _COUNTS] + [StructField(c, StringType()) for c in ("audit", "repaired_sha256")]
    schema = StructType(fields)
    marks = conversations.select("conv_id").distinct()
    rows = done.unionByName(marks, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "closing", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Report | None = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if current is None or row["conv_id"] != current.conv:
                    if current is not None:
                        out.append(current.row())
                    current = _Report(row["conv_id"])
                current.add(row)
            if out:
                yield _batch(out)
        if current is not None:
            yield _batch([current.row()])

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        kinds = [None, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
        arrays = [pa.array(list(column), kind) for column, kind in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema)
