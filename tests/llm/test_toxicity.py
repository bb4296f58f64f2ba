from __future__ import annotations

import random
import zlib

import numpy as np
from llm.helpers import EDGE_TEXTS, by_id, frame, prose, with_clashes

from tillhouse.llm import queries, text, toxicity
from tillhouse.llm.toxicity import Swap, drop_toxic, fit, held_out, scored, train


def corpus(n=600):
    """Toxic texts hold "vile", half of them also name a group; clean ones rarely do."""
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.25
        named = rng.random() < (0.8 if toxic else 0.05)
        body = prose(i, 40, 200) + (" vile" if toxic and rng.random() < 0.8 else "") + (" muslims" if named else "")
        docs.append((i, body))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_rows_and_scores(spark, sf_dir):
    rows = queries.op3_toxicity(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def auc(scores, labels):
    good, bad = np.sort(scores[labels == 0]), scores[labels == 1]
    return (np.searchsorted(good, bad).sum() + np.searchsorted(good, bad, side="right").sum()) / 2 / len(good) / len(bad)


def test_held_out_ranking_on_given_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = queries.op3_toxicity(spark, sf).where("held_out").join(labels, "doc_id").toPandas()
    assert auc(got["score"].values, got["toxic"].values) > 0.97


def test_counterfactual_swaps_lower_false_alarms_on_group_mentions(spark):
    docs, labels = corpus()
    d, lab = frame(spark, docs, "doc_id long, text string"), frame(spark, labels, "doc_id long, toxic int")
    neutral = frame(spark, [(i, prose(9000 + i, 40, 200) + " muslims") for i in range(40)], "doc_id long, text string")
    mean = {}
    for weight in (0.0, 20.0):
        model = train(d, lab, swap_weight=weight)
        mean[weight] = np.mean([r["score"] for r in scored(neutral, model).collect()])
    assert mean[20.0] < 0.8 * mean[0.0]


def test_gap_between_twins_shrinks_with_the_weight():
    same, y = [[0, 1], [0], [1], [2]], np.array([1.0, 0, 1, 0])
    gaps = []
    for weight in (0, 1, 50):
        w, _ = fit(same, y, [(2, [2])], 3, 0.0, weight, 1e-3)
        gaps.append(abs(w[1] - w[2]))
    assert gaps[0] > gaps[1] > gaps[2]


def test_swap_replaces_whole_words_within_their_line():
    swap = Swap([["men", "women"], ["solo"]])
    assert swap("Men, women and menders") == "women, men and menders" and swap("omen") is None and swap("solo") is None
    assert Swap([])("men") is None


def test_held_out_labels_change_nothing(spark):
    docs, labels = corpus(200)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    d = frame(spark, docs, "doc_id long, text string")
    one, two = (train(d, frame(spark, x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert one.bias == two.bias and (one.known == two.known).all() and (one.weights == two.weights).all()


def test_edge_rows(spark):
    docs, labels = corpus(200)
    d, lab = frame(spark, docs, "doc_id long, text string"), frame(spark, [*labels, (None, 1), (5, None), (7, 1), (7, 0)], "doc_id long, toxic int")
    odd = with_clashes(frame(spark, [(i, t) for i, t in enumerate(EDGE_TEXTS)] + [(None, "x"), (3, "x"), (3, "x")], "doc_id long, text string"))
    model = train(d, lab)
    out = scored(odd, model, name="toxicity")
    assert out.count() == len(EDGE_TEXTS) + 3 and by_id(out)[0]["toxicity"] == by_id(out)[1]["toxicity"]
    assert drop_toxic(odd, lab.limit(0)).columns == odd.columns and drop_toxic(odd, lab.limit(0)).count() == len(EDGE_TEXTS) + 3
    assert drop_toxic(odd.limit(0), lab).count() == 0
    assert [r[0] for r in odd.select(held_out(odd["doc_id"])).where("doc_id is null").collect()] == [False]


def test_features_do_not_cross_texts():
    import pyarrow as pa

    (one,) = text.chunks(pa.array(["ab", "cd", "", None, "ab cd"]))
    rows, found = toxicity.features(one)
    assert set(found[rows == 4]) == set(found[rows == 0]) | set(found[rows == 1]) and not (rows == 2).any() and not (rows == 3).any()
