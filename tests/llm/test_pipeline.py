import corpus_pipeline as C
from gaugeline.llm.common import saved


def test_stages_take_effect(spark):
    directory = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{directory}/labels.parquet").collect()}
    for name, stage in C.STAGES[:-1]:
        before = docs
        docs = saved(stage(spark, docs, directory), name)
        assert docs.columns == columns and docs.schema == before.schema
        counts.append(docs.count())
        if name == "quality":
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            good = [d for d, q in labels.items() if q]
            assert sum(d in kept for d in good) / len(good) > 0.98
            assert not [d for d, q in labels.items() if not q and d in kept][2:]
        if name == "line_dedup":
            assert docs.where("n_chars <> length(text)").count() == 0
    assert counts == sorted(counts, reverse=True) and counts[-1] < counts[0]
    packed = C.pack(spark, docs, directory)
    assert packed.select("doc_id").distinct().count() == counts[-1]


def test_odd_documents(spark, tmp_path):
    """Every stage, on rows with nulls, no text, copies and a long text."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, fp int"
    text = "One good line of words that is long enough.\nAnother line of it, as long as that."
    rows = [
        (1, text, "en", "s", 80, "x", 1), (2, text, "en", "s", 80, "x", 1), (2, text, "en", "s", 80, "x", 1),
        (None, None, None, None, None, None, None), (3, "", "en", None, 0, "x", 1),
        (4, "some other words here " * 20_000, "en", "s", 1, "x", 1),
    ]
    docs = spark.createDataFrame(rows, schema)
    for name, empty in (("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], empty).write.parquet(f"{tmp_path}/{name}.parquet")
    # No labels: every document scores 0.5 and would go, so the stage is left out here.
    assert C.keep_good(spark, docs, str(tmp_path)).count() == 0
    expected = {"line_dedup": 4, "simhash": 3, "decontaminate": 3}
    for name, stage in C.STAGES[1:-1]:
        docs = saved(stage(spark, docs, str(tmp_path)), name)
        assert docs.count() == expected[name], name
        assert docs.columns == [f.split()[0] for f in schema.split(", ")]
    assert {r.doc_id for r in C.pack(spark, docs, str(tmp_path)).collect()} == {1, 4}
    none = spark.createDataFrame([], schema)
    for _, stage in C.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0


def test_run_equals_its_stages(spark):
    directory = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    for _, stage in C.STAGES:
        docs = saved(stage(spark, docs, directory), "stage")
    rows = lambda frame: sorted(map(tuple, frame.collect()))
    assert rows(C.run(spark, directory)) == rows(docs)
