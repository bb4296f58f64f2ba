from __future__ import annotations

import hashlib

import corpus_pipeline
from llm.helpers import EDGE_TEXTS, frame, prose, with_clashes
from llm.test_bpe import library
from llm.test_decontaminate import words
from llm.test_simhash import fingerprint, roots

from tillhouse.llm import toxicity


def expected(docs: dict[int, str | None], scores: dict[int, float], items: list[str | None]) -> dict[int, str]:
    """Texts that are left, by brute force; ``docs`` in any order."""
    left = {i: t for i, t in docs.items() if scores[i] < 0.3}
    last: dict[str, int] = {}
    for i, t in left.items():
        last[t or ""] = max(last.get(t or "", i), i)
    left = {i: t for i, t in left.items() if last[t or ""] == i}
    root = roots({i: fingerprint(t) for i, t in left.items()})
    left = {i: t for i, t in left.items() if root[i] == i}
    windows: dict[int, set] = {}
    for item in items:
        w = words(item)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(n, set()).add(tuple(w[k : k + n]))

    def leaked(text):
        w = words(text)
        return any(tuple(w[k : k + n]) in known for n, known in windows.items() for k in range(len(w) - n + 1))

    return {i: t or "" for i, t in left.items() if not leaked(t)}


def check(rows, want):
    own = library()
    assert {r["doc_id"] for r in rows} == set(want) and len(rows) == len(want)
    for r in rows:
        ids = own.encode_ordinary(want[r["doc_id"]])
        assert r["token_ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(want[r["doc_id"]].encode()).hexdigest()


def test_run_equals_brute_force_on_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("labels", "benchmark"))
    model = toxicity.train(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model, carry=["doc_id"]).collect()}
    want = expected({r["doc_id"]: r["text"] for r in docs.collect()}, scores, [r["text"] for r in bench.collect()])
    assert 0 < len(want) < docs.count()
    check(corpus_pipeline.run(spark, sf_dir).collect(), want)


def test_stages_on_edge_rows(spark, tmp_path):
    texts = EDGE_TEXTS + [prose(1, 300), prose(1, 300), prose(1, 300) + " w1", "leak: " + prose(7, 30), prose(8, 20)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = with_clashes(frame(spark, rows, "doc_id long, text string, lang string, source string, n_chars long"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, [(1, prose(7, 12))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame(spark, [], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "byte_bpe"]
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
    want = expected(dict(enumerate(texts)), dict.fromkeys(range(len(texts)), 0.0), [prose(7, 12)])
    assert {r["doc_id"]: r["text"] or "" for r in kept.collect()} == want
    check(corpus_pipeline.run(spark, str(tmp_path)).collect(), want)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
