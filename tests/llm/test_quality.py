import numpy as np

import __spark_entry__ as driver
from gaugeline.llm import quality as Q


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    forest = Q.fit_forest(x, y, trees=20, depth=3, bins=32)
    scores = forest.scores(x)
    for row, score in zip(x[:50], scores[:50]):
        total = forest.base
        for tree in range(20):
            at = 0
            while at < 7:
                above = row[forest.feature[tree, at]] > forest.threshold[tree, at]
                at = 2 * at + (2 if above else 1)
            total += forest.value[tree, at - 7]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-12
    assert ((scores > 0.5) == y).mean() > 0.97


def test_statistics_of_odd_texts():
    for text in [b"", b" \n ", b"x", "é🙂".encode(), b"a " * 100_000]:
        found = Q.statistics(text)
        assert len(found) == len(Q.STATISTICS) and np.isfinite(found).all()


def test_labels_of_one_kind_or_none(spark, texts):
    docs = texts([(1, "a b"), (2, None), (None, ""), (1, "a b")])
    for rows, expected in [([], 0.5), ([(1, 1), (2, None), (77, 0)], 0.75)]:
        labels = spark.createDataFrame(rows, "doc_id bigint, quality int")
        forest = Q.fit_quality(docs, labels)
        scored = Q.score_quality(docs, forest, score_column="score")
        assert scored.columns == [*docs.columns, "score"]
        assert {round(r.score, 6) for r in scored.collect()} == {expected}
    empty = Q.score_quality(texts([]), forest)
    assert empty.count() == 0


def test_the_smallest_of_different_labels_counts(spark, texts, monkeypatch):
    docs = texts([(n, f"text {n}") for n in range(12)])
    labels = spark.createDataFrame([(n, y) for n in range(12) for y in (1, 0, 1)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(Q, "fit_forest", lambda x, y: seen.append(y.tolist()))
    for parts in (1, 7):
        Q.fit_quality(docs, labels.repartition(parts))
    assert seen[0] == seen[1] and set(seen[0]) == {0.0} and len(seen[0]) > 6


def test_held_out_rows_teach_nothing(spark):
    directory = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    labels = spark.read.parquet(f"{directory}/labels.parquet")
    from pyspark.sql import functions as F

    turned = labels.withColumn(
        "quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    one, two = Q.fit_quality(docs, labels), Q.fit_quality(docs, turned)
    assert np.array_equal(one.value, two.value)


def test_query_is_right_on_held_out_rows(spark):
    directory = "/root/testdata/sf0.1"
    found = driver.queries()["op3_quality"](spark, directory)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{directory}/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 500
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
