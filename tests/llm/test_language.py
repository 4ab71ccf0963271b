import zlib

from pyspark.sql import functions as F

from loomset.llm import language

EN = "the house and the garden with the old trees were seen by three men in the morning of that day "
DE = "das haus und der garten mit den alten baeumen wurden von drei maennern am morgen gesehen dieser "


def docs_in(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")


def test_held_out_documents_are_told_well(documents):
    model = language.fit(documents, ~language.held_out())
    assert len(model.centroids) > len(model.languages)
    docs = documents.select("doc_id", "text", language.held_out().alias("held_out"), "lang")
    got = language.predict(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r.lang == r.lang_pred for r in got if r.held_out]
    assert len(got) == documents.count() and sum(held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert language.accepted(documents, model).count() == documents.count()


def test_held_out_rows_teach_nothing(spark):
    taught = [(i, EN if i % 2 else DE, "en" if i % 2 else "de", 0.0) for i in range(60)]
    misled = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, s) for i, t, lang, s in taught]
    models = [language.fit(docs_in(spark, rows), ~language.held_out()) for rows in (taught, misled)]
    assert models[0].languages == models[1].languages == ["de", "en"]
    assert (models[0].idf == models[1].idf).all()


def test_what_has_no_letters_is_und_and_what_is_far_is_rejected(spark, odd_docs):
    docs = docs_in(spark, [(i, EN * (i + 1) if i % 2 else DE * 3, "en" if i % 2 else "de", 0.0) for i in range(40)])
    model = language.fit(docs.withColumn("lang", F.when(F.col("doc_id") > 35, None).otherwise(F.col("lang"))), F.lit(True))
    asked = docs_in(
        spark,
        [(1, None, None, 1.0), (2, "", None, 1.0), (3, "12 %& 34\n", None, 1.0), (4, EN, None, 1.0), (5, "漢字仮名交文" * 90, None, 1.0)]
        + [(6, EN * 40_000, None, 1.0), (7, "the", None, 1.0)],
    )
    got = {r.doc_id: r for r in language.predict(asked.drop("score"), model).collect()}
    assert [got[i].lang_pred for i in range(1, 8)] == ["und", "und", "und", "en", got[5].lang_pred, "en", "en"]
    assert [got[i].rejected for i in range(1, 8)] == [True, True, True, False, True, False, False]
    assert got[1].score == 0 and got[5].lang_pred in ("de", "en")
    kept = language.accepted(asked, model)
    assert kept.columns == asked.columns and sorted(r.doc_id for r in kept.collect()) == [4, 6, 7]
    assert language.predict(odd_docs.drop("lang"), model).count() == odd_docs.count()


def test_without_anything_to_learn_from_all_is_und(spark, no_docs, odd_docs):
    model = language.fit(no_docs, F.lit(True))
    assert {r.lang_pred for r in language.predict(odd_docs, model).collect()} == {"und"}
    assert language.predict(no_docs, model).collect() == []


def test_long_texts_count_like_their_pieces():
    text = "abc déf " * 70_000
    assert (language.gram_counts(text) > 0).sum() == (language.gram_counts("abc déf " * 3) > 0).sum()
    assert language.gram_counts(text).sum() > 1_000_000
