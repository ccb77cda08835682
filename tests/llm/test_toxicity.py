"""The factorization machine: gradient by differences, interactions that weights alone miss, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np

from rosterline.llm import toxicity


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_logits_equal_the_sum_over_pairs():
    draw = np.random.default_rng(1)
    weights, factors = draw.normal(size=6), draw.normal(size=(6, 3))
    texts = [[0, 2, 5], [1], [], [0, 1, 2, 3, 4, 5]]
    row = np.repeat(np.arange(4), [len(t) for t in texts])
    found, _ = toxicity._logits(0.3, weights, factors, row, np.array(sum(texts, [])), 4)
    for value, text in zip(found, texts):
        slow = 0.3 + sum(weights[t] for t in text) + sum(factors[a] @ factors[b] for i, a in enumerate(text) for b in text[i + 1 :])
        assert abs(value - slow) < 1e-12


def test_learns_what_two_terms_mean_together(spark, docs):
    draw = random.Random(3)
    filler = [f"word{k}" for k in range(200)]
    rows, labels = [], []
    for k in range(900):
        words = draw.choices(filler, k=12)
        insult, group = draw.random() < 0.5, draw.random() < 0.5
        words += ["vermin"] * insult + ["gardeners"] * group
        draw.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, int(insult and group)))
    table, marks = docs(rows), spark.createDataFrame(labels, "doc_id long, label int")
    model = toxicity.fit(table.where("doc_id < 600"), marks)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(table, model).collect()}
    assert all((found[k] >= 0.5) == bool(label) for k, label in labels if k >= 600)
    # The same terms without factors cannot tell: two single terms must then outweigh one pair.
    pair = model.logits(np.zeros(0, int), np.zeros(0, int), 1)[0]
    ask = docs([(1, "vermin"), (2, "gardeners"), (3, "vermin gardeners"), (4, "")])
    logit = {r["doc_id"]: np.log(r["score"] / (1 - r["score"])) for r in toxicity.score(ask, model).collect()}
    assert abs(logit[4] - pair) < 1e-6
    assert logit[3] - logit[4] > (logit[1] - logit[4]) + (logit[2] - logit[4]) + 1


def test_held_out_accuracy_on_the_given_tables(spark):
    import os

    import pytest

    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("given tables are not here")
    found = toxicity.op12(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = found.where("held_out").join(labels, "doc_id").toPandas()
    hit = ((rows.predicted == 1) & (rows.toxic == 1)).sum()
    assert hit >= 0.85 * (rows.toxic == 1).sum()
    assert hit >= 0.95 * (rows.predicted == 1).sum()
    assert set(found.columns) == {"doc_id", "held_out", "score", "predicted", "n_terms"} and found.count() == 10000
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in found.select("doc_id", "held_out").limit(500).collect())


def test_odd_rows(spark):
    rows = [(1, "bad bad words here", "x"), (1, "bad bad words here", "x"), (2, None, None), (3, "", None), (None, "bad words", None), (4, "fine", "y")]
    rows += [(k, f"bad words again x{k}" if k % 2 else f"quite fine text x{k}", None) for k in range(10, 40)] + [(50, "bad " * 300_000, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, label string")
    marks = spark.createDataFrame([(k, k % 2) for k in range(10, 40)] + [(None, 1), (11, None), (99, 1), (10, 0)], "doc_id long, label int")
    model = toxicity.fit(table.drop("label"), marks)
    found = toxicity.score(table, model).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    score = {r["doc_id"]: r["score"] for r in found}
    assert score[2] == score[3] == float(toxicity.sigmoid(np.array(model.bias)))
    assert score[1] > 0.5 and score[50] > 0.5 and score[None] > 0.5 and score[4] < 0.5
    assert toxicity.score(table.limit(0), model).count() == 0


def test_without_labels_or_with_one_kind(spark, docs):
    table = docs([(1, "a text"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, label int")
    assert toxicity.fit(table, none) is None
    assert [r["score"] for r in toxicity.score(table, None).collect()] == [0.0, 0.0]
    one = toxicity.fit(table, spark.createDataFrame([(1, 1)], "doc_id long, label int"))
    assert len(one.terms.keys) == 0 and one.bias > 0


def test_sample_of_labels_is_bounded(spark):
    marks = spark.range(40_000).selectExpr("id AS doc_id", "0 AS label")
    assert abs(toxicity.sampled(marks, 5_000).count() - 5_000) < 400
    assert toxicity.sampled(marks, 50_000).count() == 40_000
