def test_no_language_is_known(spark):
    import corpus_pipeline

    rows = [(1, "some text", None), (2, "1234", None), (3, None, None), (4, "é", None), (5, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = corpus_pipeline.language(spark, docs, "")
    assert found.columns == docs.columns and {r["doc_id"] for r in found.collect()} == {1, 4}


def test_predictions_decide(spark):
    import random

    import corpus_pipeline

    random.seed(2)
    words = {"aa": "lor ip dol sit amet", "bb": "kun zwei drei vier fun"}
    rows = [(i, " ".join(random.choices(words[lang].split(), k=60)), lang if i > 9 else None) for i in range(80) for lang in [sorted(words)[i % 2]]]
    noise = "".join(random.choices([chr(c) for c in range(0x4E00, 0x5E00)], k=400))
    docs = spark.createDataFrame([*rows, (100, noise, None), (101, "lor", None), (102, "12", "aa"), (103, None, "aa"), (104, noise[:50], None)], "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert {i: found[i] for i in range(80)} == {i: sorted(words)[i % 2] for i in range(80)}
    assert found[101] == "aa" and set(found) == {*range(80), 101, 104}
