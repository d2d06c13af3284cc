import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from demandloom.llm.toxicity import (
    drop_toxic, fit_toxicity, held_out, score_texts, subwords, toxicity_scores, train_from_labels,
)

BAD = ["idiot", "moron", "worthless", "pathetic", "stupid"]


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice(["the", "an", "ti", "on", "re", "ble", "sh"]) for _ in range(rng.randint(1, 4))) for _ in range(900)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(3, 200))]
        toxic = rng.random() < 0.2
        for _ in range(rng.randint(2, 5) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(BAD))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = corpus(600, 1)
    return fit_toxicity(pa.array([t for _, t, _ in rows]), np.array([y for *_, y in rows]), buckets=1 << 14)


def test_held_out_quality(model):
    rows = corpus(400, 2)
    score = score_texts(model, pa.array([t for _, t, _ in rows]))
    toxic = np.array([y for *_, y in rows], bool)
    assert (score[toxic] >= 0.3).mean() > 0.95 and (score[~toxic] >= 0.3).mean() < 0.02


def test_misspelt_words_share_subwords(model):
    score = score_texts(model, pa.array(["the idiott", "the worthles one", "the shanre one", "", None, "  "]))
    assert score[0] > 0.3 and score[1] > 0.3 and score[2] < 0.3 and (score[3:] < 0.3).all()


def test_subwords_do_not_depend_on_the_block_of_words():
    names = ["", "a", "idiot", "é" * 40, "x" * 500]
    rows, words = subwords(names, 1000)
    split_rows, split_words = subwords(names, 1000, at_once=2)
    pairs = sorted(zip(words.tolist(), rows.tolist()))
    assert pairs == sorted(zip(split_words.tolist(), split_rows.tolist()))
    assert set(words.tolist()) == set(range(5))


def test_labels_of_one_kind_give_their_mean():
    model = fit_toxicity(pa.array(["a b", "c d"]), np.zeros(2))
    assert (score_texts(model, pa.array(["idiot", ""])) < 0.3).all()


def test_queries_never_learn_from_held_out_rows(spark):
    rows = corpus(300, 3)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (train_from_labels(docs, x) for x in (labels, flipped))
    assert (a.margins == b.margins).all() and a.bias == b.bias and a.slope == b.slope
    marked = {r.doc_id: r.h for r in docs.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()}
    assert marked == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in marked}


def test_nulls_repeats_other_columns_and_empty_tables(spark, model):
    rows = [(1, None), (2, ""), (3, "you idiot"), (3, "you idiot"), (None, "fine words"), (4, "the " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("0 as score", "*", "'x' as predicted")
    found = toxicity_scores(docs, model).collect()
    assert sorted((r.doc_id or 0, r.predicted) for r in found) == [(0, 0), (1, 0), (2, 0), (3, 1), (3, 1), (4, 0)]
    assert all(0 <= r.score <= 1 for r in found)
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4]
    assert toxicity_scores(docs.limit(0), model).count() == 0 and drop_toxic(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    assert (score_texts(train_from_labels(docs, labels), pa.array(["a"])) <= 1).all()
