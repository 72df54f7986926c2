"""The pipeline's stages on sf0.001, each against what it must keep."""

import random

import corpus_pipeline
from tierflow.llm import decontam, neardup, registry

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.common.stage(function(spark, docs, SF), name)
        after = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns and after <= before and after
        if name == "near_duplicates":
            assert neardup.near_duplicates(docs).filter("not kept").isEmpty()
        if name == "decontamination":
            assert decontam.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).isEmpty()
        before = after
    rows = corpus_pipeline.shard(spark, docs, SF).collect()
    assert {r.doc_id for r in rows} == before and {r.shard for r in rows} <= set(range(40))


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "s"), (1, "a b c d e f", "en", "s"), (None, "q w e r t y", None, None), (2, None, None, None), (3, "", "en", "s")],
                                 "doc_id long, text string, lang string, source string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3]
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs.limit(0), SF).count() == 0


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(9999)}" for _ in range(40)) for _ in range(6)]
    rows = [(None, t) for t in texts[:3]] + [(None, texts[0].upper()), (7, texts[3]), (7, texts[4]), (7, None), (None, ""), (None, " ")]
    rows += [(2, texts[5]), (7, texts[5] + " more"), (9, texts[4]), (None, texts[5])]  # near copies
    docs = spark.createDataFrame([(*r, "en", f"s{i}") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(4), SF)
    assert kept.columns == docs.columns
    places = sorted(int(r.source[1:]) for r in kept.collect())
    assert places in ([0, 1, 2, 4, 5, 6, 7, 8, 9], [1, 2, 3, 4, 5, 6, 7, 8, 9])  # either of the two null rows of one text


def test_without_a_model_nothing_is_rejected(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i} other", "en", "s") for i in range(5)], "doc_id long, text string, lang string, source string")
    for name, labels in (("none", []), ("few", [(0, 1), (1, 0)])):
        spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        assert corpus_pipeline.drop_toxic(spark, docs, f"{tmp_path}/{name}").count() == 5


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {q.split("_")[0] for q in registry.QUERIES}
