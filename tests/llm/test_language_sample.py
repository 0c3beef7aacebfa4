"""Language samples of long texts, and the pipeline's first stage without any."""

import corpus_pipeline
from cardlens.llm import langid


def test_languages_of_long_texts_only_are_learned(spark):
    books = {"aa": "house river mountain bread ", "bb": "zug\nkraft\nwolke\nstein\n"}
    rows = [(i, "1 2 3 " * 900 + t * 400, lang) for i in range(20) for lang, t in books.items()]
    rows += [(100 + i, t * 300, None) for i, t in enumerate(books.values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = langid.learn(docs)
    assert list(samples) == ["aa", "bb"]
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect() if r.doc_id >= 100}
    assert got == {100: "aa", 101: "bb"}


def test_sample_is_bounded_and_ends_at_a_word(spark):
    words = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x" for i in range(5_000))
    docs = spark.createDataFrame([(i, words, "aa") for i in range(5)], "doc_id long, text string, lang string")
    found = langid.learn(docs)["aa"].split()
    assert set(found) <= set(words.split()) and 600 <= len(found) <= 1_001


def test_first_stage_keeps_texts_with_letters_when_nothing_is_learned(spark):
    rows = [(1, "some words", None), (2, "12 !!", None), (3, None, None), (4, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = corpus_pipeline.language_id(spark, docs, "unused")
    assert out.columns == docs.columns and [r.doc_id for r in out.collect()] == [1]
