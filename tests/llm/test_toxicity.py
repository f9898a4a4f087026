import random
import zlib

import numpy as np

from martloom.llm.toxicity import Settings, clean, fit, predictions, train, words_of

LAYOUT = "doc_id LONG, text STRING"
BAD = ["vilefool", "vilebrat", "rotten"]


def corpus(n=600, seed=5):
    rng = random.Random(seed)
    words = [f"w{i}x" for i in range(80)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randrange(20, 60))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                text.insert(rng.randrange(len(text)), rng.choice(BAD) if rng.random() < 0.6 else f"vile{rng.randrange(10**6)}")
        rows.append((i, " ".join(text)))
        if i % 2 or i % 12 == 0:
            labels.append((i, int(toxic)))
    return rows, labels


def test_risk_falls_back_from_overfitting_and_separates():
    """Only positives and a mixture are given; the clean rows are recognised as such."""
    rng = np.random.default_rng(0)
    x = (rng.random((3000, 20)) < 0.2).astype(np.float32)
    y = rng.random(3000) < 0.2
    x[y, 0] = rng.random(y.sum()) < 0.95
    x[~y, 0] = 0
    bias, w = fit(x[:1500][y[:1500]], x[1500:], 0.2)
    z = x @ w + bias
    assert (z[y] > 0).mean() > 0.9 and (z[~y] > 0).mean() < 0.05


def test_held_out_accuracy_and_columns(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([*rows, (9001, None), (9002, ""), (None, "w1x"), (0, rows[0][1])], LAYOUT)
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id LONG, toxic INT")
    model = train(docs, marks, Settings(least_errors=3.0))
    got = predictions(docs, model).collect()
    assert len(got) == len(rows) + 4 and docs.schema[0].name == "doc_id"
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 9000]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    caught = [r.predicted for r in held if r.doc_id % 6 == 0]
    spared = [r.predicted for r in held if r.doc_id % 6]
    assert np.mean(caught) > 0.9 and np.mean(spared) < 0.02
    assert {r.predicted for r in got if r.doc_id in (9001, 9002)} == {0}

    wide = spark.createDataFrame([(i, t, i) for i, t in rows[:60]], LAYOUT + ", score INT")
    kept = clean(wide, model)
    assert kept.columns == wide.columns and {r.doc_id for r in kept.collect()}.isdisjoint(range(0, 60, 12))


def test_the_same_model_each_time(spark):
    rows, labels = corpus(200)
    marks = spark.createDataFrame(labels, "doc_id LONG, toxic INT")
    few = Settings(least_errors=2.0, epochs=5, least_steps=5)
    models = [train(spark.createDataFrame(rows, LAYOUT).repartition(n), marks, few) for n in (1, 4)]
    assert models[0] == models[1] and models[0].weights


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], LAYOUT)
    none = spark.createDataFrame([], "doc_id LONG, toxic INT")
    assert [r.score for r in predictions(docs, train(docs, none)).collect()] == [0.0, 0.0]
    empty = spark.createDataFrame([], LAYOUT)
    assert predictions(empty, train(empty, none)).collect() == []


def test_words_and_stems():
    assert words_of("Idiot's, É!".encode()) == {b"idiot", b"s", "É".encode(), b"idio*"}
