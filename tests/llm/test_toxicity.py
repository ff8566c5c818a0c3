import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from gaugeline.llm import toxicity as X
from tests.llm.conftest import TABLES


def made_texts(count, seed=3):
    rng = np.random.default_rng(seed)
    parts = ["an", "ti", "or", "en", "the", "ol", "ba", "ke"]
    bad = ["horrible", "vermin"]
    texts, labels = [], []
    for n in range(count):
        words = ["".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(60)]
        labels.append(n % 3 == 0)
        if labels[-1]:
            for at in rng.choice(60, 3, replace=False):
                words[at] = bad[rng.integers(2)]
        texts.append(" ".join(words))
    return texts, np.array(labels, float)


def test_misspelled_words_share_the_weights_of_their_parts():
    texts, labels = made_texts(600)
    model = X.fit_bags([X.bag(t) for t in texts[:400]], labels[:400])
    score = lambda found: X.probability(X.Scorer(model).margins(found))
    assert ((score(texts[400:]) > 0.5) == labels[400:]).mean() > 0.98
    misspelled = [t.replace("horrible", "horrrible").replace("vermin", "verminn") for t in texts[400:]]
    assert ((score(misspelled) > 0.5) == labels[400:]).mean() > 0.95


def test_remembered_sums_equal_the_averaged_bag():
    texts = ["Idiot! of the on", "", None, " .,; ", "x" * 500 + " a-b", "the the the"]
    rng = np.random.default_rng(1)
    model = X.Model(rng.normal(size=X.BUCKETS).astype(np.float32), 0.25)
    scorer = X.Scorer(model)
    for _ in range(2):
        for text, margin in zip(texts, scorer.margins(texts)):
            bucket, share = X.bag(text)
            assert abs((model.weight[bucket] * share).sum() + 0.25 - margin) < 1e-4


def test_subwords_are_those_of_each_word_alone():
    words = ["a", "idiot", "🙂é", "x" * 40, "of", "idiot"]
    bucket, owner = X.subwords(words)
    for at, word in enumerate(words):
        alone, one = X.subwords([word])
        assert sorted(bucket[owner == at].tolist()) == sorted(alone.tolist()) and not one.any()
        assert len(alone) == sum(max(0, len(word) + 3 - n) for n in X.GRAMS)


def test_odd_labels_and_rows(spark, texts):
    docs = texts([(1, "a b"), (2, None), (None, ""), (1, "a b"), (5, "word " * 3)])
    for rows, expected in [([], 0.5), ([(1, 1), (2, None), (77, 0), (None, 1), (5, 3)], 0.75)]:
        model = X.fit_toxicity(docs, spark.createDataFrame(rows, "doc_id bigint, toxic int"))
        scored = X.score_toxicity(docs, model)
        assert scored.columns == [*docs.columns, "score"]
        assert {round(r.score, 6) for r in scored.collect()} == {expected}
    # Of two labels of an id the smaller one counts.
    labels = spark.createDataFrame([(1, 1), (1, 0)], "doc_id bigint, toxic int")
    assert abs(X.fit_toxicity(docs, labels).bias - np.log(1 / 3)) < 1e-6
    assert X.score_toxicity(texts([]), model).count() == 0
    with pytest.raises(ValueError):
        X.score_toxicity(docs, model, score_column="FP")


def test_the_sample_is_bounded_by_rows_and_entries(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text{i} of") for i in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int")
    seen = []
    monkeypatch.setattr(X, "fit_bags", lambda bags, y: seen.append((len(bags), sum(len(b) for b, _ in bags))))
    for how in ({}, {"sample_rows": 7}, {"sample_entries": 60}):
        X.fit_toxicity(docs, labels, **how)
    assert seen[0][0] > 20 and seen[1][0] == 7 and 0 < seen[2][1] <= 60


def test_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    turned = labels.withColumn(
        "toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    one, two = X.fit_toxicity(docs, labels), X.fit_toxicity(docs, turned)
    assert np.array_equal(one.weight, two.weight) and one.bias == two.bias


def test_query_on_held_out_rows(spark):
    directory = "/root/testdata/sf0.1"
    found = driver.queries()["op13_toxicity"](spark, directory)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{directory}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    clean = [r.predicted for r in rows if not r.toxic]
    # About a third of the labels 1 are noise: texts with nothing toxic in them.
    toxic = [r.predicted for r in rows if r.toxic]
    assert len(clean) > 500 and np.mean(clean) < 0.03 and np.mean(toxic) > 0.6
