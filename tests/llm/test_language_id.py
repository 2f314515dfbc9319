from catalogflow.llm import language_id


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 1000 and 250 < len(held) < 420
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_rows_do_not_teach(spark, sample):
    from pyspark.sql import functions as F

    spoiled = sample.withColumn(
        "text",
        F.when(language_id.held_out(F.col("doc_id")), F.lit("zzzz")).otherwise(F.col("text")),
    )
    first = language_id.learn(sample, "doc_id", "text", "lang")
    second = language_id.learn(spoiled, "doc_id", "text", "lang")
    assert (first.weights == second.weights).all() and (first.offsets == second.offsets).all()


def test_odd_rows(odd, empty, sample):
    model = language_id.learn(sample, "doc_id", "text", "lang")
    found = {r.doc_id: r.lang_pred for r in language_id.predict(odd, model).collect()}
    assert [found[i] for i in (1, 2, 3, 8)] == ["und"] * 4
    assert found[4] in ("de", "en", "es", "fr")
    # Nothing is labelled: nothing is known.
    assert {(r.lang_pred, r.score) for r in language_id.identify(odd).collect()} == {("und", 0.0)}
    assert language_id.identify(empty).count() == 0


def test_families():
    assert language_id.family_of("es") == language_id.family_of("pt-BR") == "romance"
    assert language_id.family_of("xx") == "only xx"
