from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from llm.helpers import frame, with_clashes

from tillhouse.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
TEXTS = ["fine.", "good!", "cut off", "", " \t", "ok?", "end. \n", None, "long " * 2000]
ROLES = ["user", "assistant", "system", "tool", "", None, "u", "supervisor"]


def in_order(rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


LEGAL = re.compile("(s?(ua)+)?")


def searched(rows):
    """All edits of a few rows, tried one by one: cost, audit, body."""
    found, ways = faults(rows), []
    for (_, role, text), fault in zip(rows, found):
        options = [(4, "D", [])]
        if fault not in ("blank", "duplicate"):
            fee = 3 if fault == "truncated" else 0
            for n in range(3):
                for put in product(["user", "assistant"], repeat=n):
                    before = [(x, "") for x in put]
                    if role:
                        options.append((3 * n + fee, "I" * n + "K", [*before, (role, text)]))
                    options += [(3 * n + fee + 3, "I" * n + "R", [*before, (x, text)]) for x in ("user", "assistant")]
        ways.append(options)
    ways.append([(3 * n, "I" * n, [(x, "") for x in put]) for n in range(3) for put in product(["user", "assistant"], repeat=n)])
    best = None
    for way in product(*ways):
        body = [x for _, _, part in way for x in part]
        if LEGAL.fullmatch("".join(r[0] for r, _ in body)):
            this = (sum(w[0] for w in way), "".join(w[1] for w in way), body)
            best = this if best is None or this[:2] < best[:2] else best
    return best


def walked(rows):
    """The same by a plain table of states, for long conversations."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}
    for (_, role, text), fault in zip([*rows, (None, None, None)], [*faults(rows), "end"]):
        after: dict = {}

        def offer(state, cost, audit, body):
            if state not in after or (cost, audit) < after[state][:2]:
                after[state] = (cost, audit, body)

        for state, (cost, audit, body) in best.items():
            if fault == "end":
                while True:
                    if state in ("", "a"):
                        offer("", cost, audit, body)
                        break
                    state = step[state]
                    cost, audit, body = cost + 3, audit + "I", (*body, (name[state], ""))
                continue
            offer(state, cost + 4, audit + "D", body)
            fee = 3 if fault == "truncated" else 0
            for _ in range(0 if fault in ("blank", "duplicate") else 3):
                to = step[state]
                offer(to, cost + fee + 3, audit + "R", (*body, (name[to], text)))
                if role[:1] == to:
                    offer(to, cost + fee, audit + "K", (*body, (role, text)))
                if role[:1] == "s" and state == "":
                    offer("s", cost + fee, audit + "K", (*body, (role, text)))
                state, cost, audit, body = to, cost + 3, audit + "I", (*body, (name[to], ""))
        best = after
    cost, audit, body = best[""]
    return cost, audit, list(body)


def expected(rows, way):
    rows = in_order(rows)
    found, turns = faults(rows), sorted({r[0] for r in rows if r[0] is not None})
    cost, audit, body = way(rows)
    return {
        "gaps": turns[-1] - turns[0] + 1 - len(turns) if turns else 0,
        **{f: found.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in body).encode()).hexdigest(),
    }


def conversations(seed, n, most):
    rng = random.Random(seed)
    out = {}
    for conv in range(n):
        rows = [(rng.choice([None, *range(6)]), rng.choice(ROLES[: rng.choice([3, 8])]), rng.choice(TEXTS)) for _ in range(rng.randint(1, most))]
        out[conv] = rows + [rng.choice(rows)] * rng.choice([0, 0, 2])
    return out


def reported(df, whole=None):
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in repair.report(df, whole).collect()}


def table(spark, data):
    return frame(spark, [(conv, *r) for conv, rows in data.items() for r in rows], SCHEMA)


def test_short_conversations_equal_exhaustive_search(spark):
    data = conversations(1, 60, 3)
    data[None] = [(0, "user", "null id."), (1, "user", "cut")]
    rows = table(spark, data)
    got = reported(repair.edited(with_clashes(rows)), rows)
    assert got == {conv: expected(r, searched) for conv, r in data.items()}


@pytest.mark.parametrize("bits,final", [(repair.BLOCK_BITS, repair.FINAL), (1, 2), (2, 1)])
def test_long_conversations_equal_plain_dp_however_they_are_split(spark, bits, final):
    rng = random.Random(5)
    data = conversations(2, 8, 12)
    data[100] = [(t, rng.choice(ROLES[:4]), f"{rng.random()}{rng.choice('.!? x')}") for t in range(700)]
    data[101] = [(None, "user", "all the same.")] * 900 + [(3, "assistant", "cut")]
    rows = table(spark, data).repartition(5)
    got = reported(repair.edited(rows, bits, final), rows)
    assert got == {conv: expected(r, walked) for conv, r in data.items()}


def test_search_and_plain_dp_agree():
    for rows in conversations(3, 40, 3).values():
        rows = in_order(rows)
        assert searched(rows)[:2] == walked(rows)[:2]


def test_repaired_rows_are_legal_and_digest_alike(spark):
    data = conversations(4, 30, 8)
    rows = table(spark, data)
    left: dict = {}
    for r in repair.repaired(rows).orderBy("conv_id", "closing", "place", "part").collect():
        left.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for conv, wanted in reported(repair.edited(rows), rows).items():
        body = left.get(conv, [])
        assert LEGAL.fullmatch("".join(r[0] for r, _ in body))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in body).encode()).hexdigest() == wanted["repaired_sha256"]


def test_damage_follows_the_checksum(spark):
    data = [(c, t, "assistant" if t % 2 else "user", f"One. {c} two! {t}?") for c in range(30) for t in range(8)]
    data += [(None, 1, "user", "a."), (5, None, None, "b?"), (7, None, "system", None)]
    want = []
    for c, t, role, text in data:
        known = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{known(c)}:{known(t)}".encode()) % 20
        role, text = known(role), known(text)
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        want += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = [tuple(r) for r in repair.damaged(frame(spark, data, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_conversations_without_rows_and_empty_tables(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = frame(spark, [(gone, 0, "user", "text.")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    zeros = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    assert reported(repair.edited(repair.damaged(rows)), rows) == {gone: {**zeros, "audit": "", "repaired_sha256": empty}}
    none = frame(spark, [], SCHEMA)
    assert reported(repair.edited(repair.damaged(none)), none) == {} and repair.repaired(none).count() == 0
