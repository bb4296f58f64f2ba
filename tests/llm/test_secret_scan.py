from __future__ import annotations

import hashlib
import random
import re

from llm.helpers import EDGE_TEXTS, by_id, frame, with_clashes

from tillhouse.llm import queries, secret_scan
from tillhouse.llm.secret_scan import redacted, secret_spans

KEY = "AKIA" + "Q7" * 9
RANDOM = "".join(random.Random(4).choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=40))
TEXTS = EDGE_TEXTS + [
    "é password = 'hunter22' and Passwd:\"abc\" api_key: x-1234567 APIKEY=short1 token  ==  aaaaaaa",
    f"key {KEY} and AKIA123 " + "0123456789abcdef" * 2 + " deadbeef" + "ſecret=abcdefgh toKen=abcdefgh",  # long s, Kelvin sign
    f"Authorization: Bearer {RANDOM} end",
    f"the recipe {RANDOM} has no such context",
    "auth path /usr/lib/python3/dist-packages/aaaaaaaaaaaaaaaa1111111111111111",
    "secret:" + "0" * 64 + " secret: ",
    "token=" + "ab1" * 3000,
]


def brute(text):
    """Kinds by scanning from every position."""
    text, out = text or "", []
    at = 0
    rules = [
        ("assign", re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[1]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ]
    for kind, pattern, good in rules:
        at = 0
        while at < len(text):
            m = pattern.match(text, at)
            if m and good(m):
                out.append((m.start(), kind, m.end()))
            at = m.end() if m else at + 1
    order = {"assign": 0, "access": 1, "hex": 2}
    return [(k, s, e) for s, k, e in sorted(out, key=lambda x: (x[0], order[x[1]]))]


def test_base_spans_equal_brute_force(spark, sf_dir):
    rows = list(enumerate(TEXTS)) + [(1000 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = by_id(secret_spans(with_clashes(frame(spark, rows, "doc_id long, text string"))))
    found = 0
    for i, text in rows:
        base = [(s["kind"], s["start"], s["end"]) for s in got[i]["spans"] if s["kind"] != "novel"]
        assert base == brute(text), text
        found += len(base)
    assert found > 10


def test_novel_spans_need_context_and_are_incompressible(spark):
    got = by_id(secret_spans(frame(spark, list(enumerate(TEXTS)), "doc_id long, text string")))
    novel = {i: [TEXTS[i][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == "novel"] for i, r in got.items()}
    assert [x for v in novel.values() for x in v] == [RANDOM]
    assert novel[len(EDGE_TEXTS) + 2] == [RANDOM]


def test_digest_query_and_redaction(spark, sf_dir):
    row = {r["doc_id"]: r for r in queries.op8_secrets(spark, sf_dir).collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert row.keys() == docs.keys()
    for i, text in docs.items():
        want = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(text))
        assert row[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert row[i]["n_hex"] == want.count("hex:") and row[i]["n_assign"] == want.count("assign:")
    clean = by_id(redacted(with_clashes(frame(spark, [(1, f"x {KEY} y"), (2, None), (3, "plain")], "doc_id long, text string"))))
    assert clean[1]["text"] == "x [secret] y" and clean[2]["text"] is None and clean[3]["text"] == "plain" and clean[1]["key"] == "own"


def test_empty_table(spark):
    assert secret_spans(frame(spark, [], "doc_id long, text string")).count() == 0
    assert secret_scan.base_spans("") == []


def test_a_label_behind_the_value_is_context_too():
    for text in (f"{RANDOM} # stripe secret", f"run '{RANDOM}' is the access token", f"{RANDOM}\n(login)"):
        found = secret_scan.novel_spans(text, [], secret_scan.Novelty())
        assert [text[low:high] for _, low, high in found] == [RANDOM]
    far = f"{RANDOM}{' x' * 80} secret"
    assert secret_scan.novel_spans(far, [], secret_scan.Novelty()) == []


def test_long_texts_take_linear_time():
    """A text of many spans and runs: both are walked together."""
    import time

    values = " ".join(f"{random.Random(k).getrandbits(128):032x}" for k in range(60_000))
    start = time.perf_counter()
    taken = secret_scan.base_spans(values)
    assert len(taken) == 60_000 and secret_scan.novel_spans(values, taken, secret_scan.Novelty()) == []
    assert time.perf_counter() - start < 8


def test_runs_that_touch_no_span_are_measured_in_any_order():
    novelty = secret_scan.Novelty()
    text = f"token=abcdefgh and the secret {RANDOM} or key {'0123456789abcdef' * 2} then bearer {RANDOM[::-1]}"
    spans = secret_scan.novel_spans(text, secret_scan.base_spans(text), novelty)
    assert [text[a:b] for _, a, b in spans] == [RANDOM, RANDOM[::-1]]
    long_words = "the secret is internationalization and characteristically incomprehensibilities"
    assert secret_scan.novel_spans(long_words, [], novelty) == []


def planted(n, seed=9):
    """Texts with a random key behind a label, and the same with a path, a word or a repetition in its place."""
    rng = random.Random(seed)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choices(letters, k=rng.randrange(20, 50))) for _ in range(n)]
    plain = [rng.choice(["usr/lib/python3/dist-packages/module_1", "aaaaaaaaaaaaaaaaaaaaaaaaa1", "configuration_settings_environment_1", "username_password_default_value_2"]) for _ in range(n)]
    labels = [rng.choice(["bearer ", "my credential is ", "auth key ", "private signature "]) for _ in range(n)]
    return [f"some text, {a}{b} and more" for a, b in zip(labels, keys)], [f"some text, {a}{b} and more" for a, b in zip(labels, plain)]


def test_planted_keys_are_found_and_plain_runs_are_not():
    novelty = secret_scan.Novelty()
    keys, plain = planted(300)
    found = [bool(secret_scan.novel_spans(t, secret_scan.base_spans(t), novelty)) for t in keys]
    false = [bool(secret_scan.novel_spans(t, secret_scan.base_spans(t), novelty)) for t in plain]
    assert sum(found) / len(found) > 0.95 and sum(false) / len(false) < 0.02
