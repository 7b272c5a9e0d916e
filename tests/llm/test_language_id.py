from pyspark.sql import functions as F
from reference import crc

from wardledger.llm.language_id import UNKNOWN, Model, fit, identify, letter_words, predict_languages

HELD = "crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = predict_languages(docs).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(held) / len(held) > 0.97


def test_labels_of_held_out_rows_are_not_used(spark, documents):
    train = documents.where("crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2")
    other = documents.exceptAll(train).selectExpr("doc_id", "text", "'xx' AS lang")
    both = train.select("doc_id", "text", "lang").unionAll(other)
    assert "xx" not in fit(both).languages
    a = {r["doc_id"]: r["lang_pred"] for r in predict_languages(both).collect()}
    assert a == {r["doc_id"]: r["lang_pred"] for r in predict_languages(documents).collect()}


def test_words_first_then_shorter_grams(spark):
    rows = [(i, t, x) for i, (t, x) in enumerate([("house garden river", "en"), ("maison jardin fleuve", "fr")] * 20)]
    model = fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    names, share = model.predict(["garden", "gardening", "fleuves", "jar", "123", "", None, "日本"])
    assert list(names[:4]) == ["en", "en", "fr", "fr"] and list(names[4:7]) == [UNKNOWN] * 3 and list(share[4:7]) == [0, 0, 0]
    assert names[7] in ("en", "fr") and abs(share[7] - 0.5) < 0.01  # letters, but nothing known of them


def test_long_text_does_not_end_the_sample(spark):
    """Two languages; the first English text by hash is longer than all that a sample may hold."""
    words = {"en": "house garden river stone window", "fr": "maison jardin fleuve pierre fenetre"}
    rows = [(i, " ".join(f"{w}{'abcdefghij'[i // 2 % 10]}" for w in words[x].split()), x) for i in range(400) for x in [("en", "fr")[i % 2]]]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    first = plain.where(f"lang = 'en' AND NOT ({HELD})").orderBy(F.expr("shiftrightunsigned(xxhash64(cast(doc_id AS string)), 11)")).first()["doc_id"]
    long = [(i, "foreign " * 260_000 if i == first else t, x) for i, t, x in rows]
    found = predict_languages(spark.createDataFrame(long, plain.schema)).where("held_out").collect()
    assert {(r["doc_id"], r["lang_pred"]) for r in found} == {(i, x) for i, _, x in rows if crc(i) % 4 == 2}
    only = spark.createDataFrame([(i, "foreign " * 20_000, "en") for i in range(8)], plain.schema)
    assert fit(only).languages == ["en"]  # a language of long texts alone is learned from them


def test_words_of_letters():
    words = letter_words(["Ab1cd, é", "", "ΣΑ"])
    assert words.count.tolist() == [3, 0, 1]


def test_odd_rows(odd, nothing):
    found = {(r["doc_id"], r["lang_pred"]) for r in predict_languages(odd).collect()}
    assert {(1, UNKNOWN), (2, UNKNOWN), (3, UNKNOWN), (10, UNKNOWN), (None, UNKNOWN)} <= found
    assert identify(odd, fit(odd)).select("row.*").columns == odd.columns
    assert predict_languages(nothing).count() == 0
    unlabelled = odd.selectExpr("doc_id", "text", "cast(NULL AS string) AS lang")
    assert {r["lang_pred"] for r in predict_languages(unlabelled).collect()} == {UNKNOWN}
    assert Model([], {}).predict(["a"])[0].tolist() == [UNKNOWN]
