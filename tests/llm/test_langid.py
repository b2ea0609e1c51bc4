import re

from pyspark.sql import functions as F

from quayside.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(docs.where(~langid.held_out("doc_id")), scratch)
    rows = langid.predict(docs, model, ["doc_id", "lang"]).where(langid.held_out("doc_id")).collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)


def test_mixtures_are_found(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(docs, scratch)
    texts = {k: [r["text"] for r in docs.where((F.col("lang") == k) & (F.length("text") > 1500)).limit(3).collect()] for k in ("en", "de", "fr")}
    mixed = spark.createDataFrame([(0, texts["en"][0][:1500] + " " + texts["de"][0][:600]), (1, texts["fr"][0][:900] + " " + texts["de"][1][:900] + " " + texts["en"][1][:900]), (2, texts["en"][2])], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in langid.predict(mixed, model, ["doc_id"]).collect()}
    assert set(rows[0]["shares"]) == {"de", "en"} and rows[0]["lang_pred"] == "en" and 0.55 < rows[0]["score"] < 0.85
    assert set(rows[1]["shares"]) == {"de", "en", "fr"}
    assert set(rows[2]["shares"]) == {"en"} and rows[2]["score"] == 1.0


def test_other_columns_do_not_matter(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 50")
    model = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"), scratch)
    other = docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id") + 1000)
    a = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model, ["doc_id"]).collect()}
    assert a == {r["doc_id"] - 1000: (r["lang_pred"], r["score"]) for r in langid.predict(other, model, ["doc_id"]).collect()}


def test_odd_rows(spark, scratch, odd_documents):
    model = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"), scratch)
    rows = {r["doc_id"]: r for r in langid.predict(odd_documents, model, odd_documents.columns[:5]).collect()}
    for i, text in ((0, None), (1, ""), (5, "  "), (7, "123 $%")):
        assert not re.search(r"[^\W\d_]", text or "") and rows[i]["lang_pred"] == langid.UNKNOWN and rows[i]["score"] == 0
    assert all(rows[i]["lang_pred"] in model[0] and 0 < rows[i]["score"] <= 1 for i in (2, 3, 6, None))


def test_nothing_to_learn_from(spark, scratch, odd_documents):
    model = langid.learn(odd_documents.where(F.lit(False)), scratch)
    assert model[0] == [] and {r["lang_pred"] for r in langid.predict(odd_documents, model, ["doc_id"]).collect()} == {langid.UNKNOWN}
    assert langid.predict(odd_documents.where(F.lit(False)), model, ["doc_id"]).count() == 0


def test_learning_where_one_language_has_only_wordless_texts(spark, scratch):
    docs = spark.createDataFrame([(0, "123", "en"), (1, "bonjour le monde", "fr"), (2, "", "de")], "doc_id long, text string, lang string").coalesce(1)
    languages, table = langid.learn(docs, scratch)
    assert languages == ["fr"] and table.shape == (langid.BUCKETS, 1)


def test_the_ids_with_the_least_hashes_are_learnt_from(spark, scratch):
    docs = spark.range(5000).selectExpr("id AS doc_id", "'x' AS text", "IF(id % 50 = 0, 'rare', 'often') AS lang")
    docs = docs.unionByName(docs.where("doc_id < 100"))
    got = {(r["lang"], r["id"]) for r in langid._chosen(docs, "doc_id", "lang", 300, scratch).collect()}
    rows = docs.distinct().selectExpr("lang", "doc_id", "xxhash64(doc_id) AS h").collect()
    expected = set()
    for lang in ("rare", "often"):
        some = sorted((r["h"] % 2**64, r["doc_id"]) for r in rows if r["lang"] == lang)[:300]
        expected |= {(lang, i) for _, i in some}
    assert got == expected
