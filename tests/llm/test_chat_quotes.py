from __future__ import annotations

import random

import duckdb
from llm.helpers import frame, prose, with_clashes
from oracle_check import canonical

from tillhouse.llm import queries
from tillhouse.llm.chat_quotes import positions, reply_ordered, threads

SCHEMA = "conv_id long, turn long, role string, text string"
TALK = [
    (1, 0, "user", "How do I  sort a list?\nIt is long."),
    (1, 1, "assistant", "Use sorted. It is stable!"),
    (1, 2, "user", "Another matter."),
    (1, 3, "assistant", "> It is STABLE!\n\nMore on that."),
    (1, 4, "user", ">> How do I sort a list?\n>> It is long.\n> Use sorted. It is stable!\nThanks"),
    (1, 5, "user", "> > nobody said this\nHm"),
    (1, 6, "assistant", "> another matter.\r\n> and unknown words\r\nYes."),
    (1, 7, "user", "> More on that.\nGood."),
    (2, 0, "user", "It is stable!"),
    (2, 1, None, None),
    (2, 2, "user", ""),
    (2, 2, "user", "> It is stable!"),
    (2, 2, "user", "> It is stable!"),
    (2, 3, "user", ">\n> \n  > >>"),
    (None, 1, "user", "> It is stable!"),
    (2, None, "user", "> It is stable!"),
]


def spark_rows(df):
    return canonical([tuple(r) for r in df.collect()], df.columns)


def sql_rows(rows):
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    if rows:
        con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    found = con.sql(queries.ORACLE["op2_chat_quotes"])
    return canonical(found.fetchall(), found.columns)


def made_up(seed):
    """Conversations whose messages quote whole texts, lines or sentences of earlier ones, to several levels."""
    rng, rows = random.Random(seed), []
    for conv in range(6):
        texts: list[str] = []
        for turn in range(rng.randrange(1, 25)):
            own = "\n".join(". ".join(prose(rng.randrange(10**6), 3, 9) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 3)))
            quotes = []
            for _ in range(rng.randrange(3) if texts else 0):
                source = rng.choice(texts)
                some = rng.choice([source, rng.choice(source.split("\n")), rng.choice(source.split(". "))])
                mark = rng.choice([">", "> ", " > "])
                quotes.append("\n".join(mark + line for line in some.split("\n")))
            texts.append("\n".join([*quotes, own]) if rng.random() < 0.7 else "\n".join([own, *quotes]))
            rows.append((conv, turn, rng.choice(["user", "assistant"]), texts[-1]))
    return rows


def test_known_conversation(spark):
    got = {(r["conv_id"], r["turn"]): r for r in reply_ordered(with_clashes(frame(spark, TALK[:8], SCHEMA))).collect()}
    parent = {t: got[1, t]["parent_turn"] for t in range(8)}
    assert parent == {0: None, 1: None, 2: None, 3: 1, 4: 1, 5: None, 6: 2, 7: 3}
    assert [t for _, t in sorted((r["position"], r["turn"]) for r in got.values())] == [0, 1, 3, 4, 7, 2, 6, 5]
    assert got[1, 4]["text"] == "Thanks" and got[1, 4]["n_quotes"] == 2 and got[1, 4]["n_linked"] == 2 and got[1, 7]["depth"] == 2
    assert got[1, 3]["chat"] == "<|assistant|>\nMore on that."


def test_equals_sql_on_quotes_and_edge_rows(spark):
    for rows in (TALK, made_up(1) + TALK, made_up(2), []):
        assert spark_rows(reply_ordered(frame(spark, rows, SCHEMA))) == sql_rows(rows)


def test_long_chain_of_answers(spark):
    rows = [(1, t, "user", (f"> say {t - 1}\n" if t else "") + f"say {t}") for t in range(40)]
    got = {r["turn"]: (r["depth"], r["root_turn"], r["position"]) for r in reply_ordered(frame(spark, rows, SCHEMA)).collect()}
    assert got == {t: (t, 0, t) for t in range(40)}


def test_threads_and_positions(spark):
    parents = frame(spark, [(1, i, i // 2) for i in range(1, 60)], "conv_id long, turn long, parent long")
    got = {r["turn"]: (r["root"], r["depth"]) for r in threads(parents).collect()}
    assert got == {i: (0, i.bit_length()) for i in range(1, 60)}
    rows = frame(spark, [(k % 3 or None, k * 37 % 101) for k in range(100)] + [(2, 5)] * 30, "g long, v long")
    for group in (None, 1, 2):
        mine = sorted((r["position"], r["v"]) for r in positions(rows, "g", ["v"]).collect() if r["g"] == group)
        assert [p for p, _ in mine] == list(range(len(mine))) and [v for _, v in mine] == sorted(v for _, v in mine)


def test_no_python_in_the_plan(spark):
    plan = reply_ordered(frame(spark, TALK, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
