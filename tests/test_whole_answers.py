"""Answers that stand beyond a document's beginning."""

from corvid.plans import registry


def test_answers_are_scored_on_the_whole_document(spark, tmp_path):
    head = " ".join(f"head{k}" for k in range(60))
    passage = "the quick brown fox jumps over the lazy dog today"
    docs = [(1, head + " " + passage, "en", "s"), (2, "something else entirely", "en", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    schema = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").schema
    item = tuple({"item_id": 1, "text": passage}.get(f.name) for f in schema)
    spark.createDataFrame([item], schema).write.parquet(f"{tmp_path}/benchmark.parquet")
    rouge = registry.queries()["ev11_rouge_l"](spark, str(tmp_path)).collect()
    assert [(r.id, r.score) for r in rouge] == [(1, round(2 * 10 / (70 + 10), 6))]
    found = registry.queries()["ev13_bleu"](spark, str(tmp_path)).first()
    assert found.bleu > 0 and found.pred_tokens == 70
