import numpy as np
from pyspark.sql import functions as F

from tickloom.llm import language


def test_scores_equal_a_plain_naive_bayes(spark):
    rows = [("aab", "x"), ("abb ba", "x"), ("ccd", "y"), ("cd dc", "y"), ("dcc", "y")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = language.fit(docs)
    assert model["names"] == ["x", "y"]
    counts = np.zeros((language.BUCKETS, 2))
    for text, lang in rows:
        for _, bucket in language.grams([text], language.ORDERS, language.BUCKETS):
            np.add.at(counts[:, "xy".index(lang)], bucket, 1)
    logs = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * language.BUCKETS))
    for text in ["ab", "dc", "abc dd"]:
        total = np.log(np.array([2, 3]) / 5)
        for _, bucket in language.grams([text], language.ORDERS, language.BUCKETS):
            total = total + logs[bucket].sum(axis=0)
        want = np.exp(total - total.max())
        want /= want.sum()
        (name,), (prob,) = language.score_texts([text], model)
        assert name == "xy"[want.argmax()] and abs(prob - want.max()) < 1e-4


def test_pieces_of_a_long_text_add_up():
    text = "abc def " * 300_000
    whole = sum(len(b) for _, b in language.grams([text], (2,), 1 << 15))
    assert abs(whole - 8 * 300_000) <= 10


def test_held_out_languages(spark):
    out = language.op8_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = out.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


def test_odd_rows(odd, none):
    model = language.fit(odd)
    got = language.identify(odd, model).collect()
    assert len(got) == odd.count() and "spans" in got[0].asDict()
    for r in got:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in model["names"] and 0 <= r["score"] <= 1
    assert language.identify(none, language.fit(none)).count() == 0
    assert language.identify(odd, language.fit(none)).where("lang_pred <> 'und'").count() == 0
    kept = language.accepted(odd)
    assert kept.columns == odd.columns and kept.where("text is null or text = ''").count() == 0
    assert language.accepted(none).count() == 0
