"""Toxicity and languages: accuracy on rows that taught nothing, and odd rows."""

import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import languages, toxicity
from holdfast.llm.queries import op4_toxicity, op7_language_id

FOLDER = "/root/testdata/sf0.1"
ODD = [(10**7, None), (10**7 + 1, ""), (10**7 + 2, " \n"), (None, "no id"), (None, None), (10**7 + 3, "123 !! 456"), (5, "twice"), (5, "twice"), (6, "word " * 60_000)]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    docs, labels = tables
    return toxicity.fit(docs, labels.where("doc_id % 3 <> 1"))


def test_toxicity_of_documents_not_taught(tables, model):
    docs, labels = tables
    found = toxicity.score_toxicity(docs, model).join(labels.where("doc_id % 3 = 1"), "doc_id").toPandas()
    toxic = found["toxic"] == 1
    assert found.loc[toxic, "rejected"].mean() > 0.85
    assert found.loc[~toxic, "rejected"].mean() < 0.01
    assert found.loc[toxic, "expected_severity"].mean() > 1 > 0.1 > found.loc[~toxic, "expected_severity"].mean()
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == toxicity.GRADES - 1
    grades = found.groupby("grade")["expected_severity"].mean()
    assert grades.is_monotonic_increasing and ((found["grade"] > 0) == found["rejected"]).all()


def test_toxicity_of_odd_rows(frame, model, prose):
    df = frame([(k, t, 1.0, "x") for k, t in ODD], "doc_id bigint, text string, grade double, rejected string")
    got = toxicity.score_toxicity(df, model)
    assert got.columns == ["doc_id", "grade", "expected_severity", "p_toxic", "rejected"]
    rows = got.collect()
    assert len(rows) == len(ODD)
    assert all(r["expected_severity"] == 0 for r in rows if r["doc_id"] in (10**7, 10**7 + 1, 10**7 + 2, 10**7 + 3))
    kept = toxicity.without_toxic(df.union(frame([(9, "idiot scum moron idiot you worthless clown", 1.0, "x")], df.schema)), model)
    assert kept.columns == df.columns and kept.count() == len(ODD)
    assert toxicity.score_toxicity(frame([]), model).collect() == []


def test_toxicity_without_both_labels(frame):
    docs, labels = frame([(1, "a"), (2, None)]), frame([(1, 0), (None, 1), (2, None), (1, 0)], "doc_id bigint, toxic int")
    assert toxicity.fit(docs, labels) is None
    assert toxicity.fit(frame([]), frame([], "doc_id bigint, toxic int")) is None
    assert [r["rejected"] for r in toxicity.score_toxicity(docs, None).collect()] == [False, False]


def test_ordinal_regression_orders_grades():
    dice = np.random.default_rng(3)
    truth, n = np.array([2.0, 0.7, -1.5, 0.0]), 4000
    x = dice.random((n, 4)) < 0.5
    score = x @ truth + dice.logistic(size=n)
    grades = np.searchsorted([0.0, 1.0, 2.5], score)
    rows, columns = np.nonzero(x)
    weights, rate, thresholds = toxicity.fit_ordinal(rows, columns, np.zeros(n), grades, 4, ridge=0.0)
    assert np.allclose(weights, truth, atol=0.25) and np.allclose(thresholds, [0.0, 1.0, 2.5], atol=0.25) and rate == 0


def test_languages_of_documents_not_taught(spark, tables):
    found = op7_language_id(spark, FOLDER).join(tables[0].select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    right, all_of = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right > 0.99 and all_of > 3000
    # The share is what stays when crc32 of the id as text leaves 1.
    import zlib

    row = found.first()
    assert zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1


@pytest.fixture(scope="module")
def four(tables):
    return languages.learn(tables[0].where("doc_id < 3000"))


def test_mixtures_of_two_languages(tables, four, frame):
    pool = {}
    for lang in ("de", "en", "fr"):
        rows = tables[0].where(f"lang = '{lang}' AND doc_id > 5000 AND length(text) > 4000").orderBy("doc_id").limit(1).collect()
        pool[lang] = rows[0]["text"].split()[:400]
    rows = [(1, " ".join(pool["de"] + pool["en"][:133])), (2, " ".join(pool["fr"][:100] + pool["en"][:100])), (3, " ".join(pool["fr"]))]
    got = {r["doc_id"]: {x["lang"]: x["share"] for x in r["languages"]} for r in languages.predict(frame(rows), four).collect()}
    assert set(got[1]) == {"de", "en"} and abs(got[1]["de"] - 0.75) < 0.06
    assert set(got[2]) == {"en", "fr"} and abs(got[2]["fr"] - 0.5) < 0.08
    assert set(got[3]) == {"fr"}


def test_languages_of_odd_rows(frame, four):
    df = frame([(k, t, 0.5, 1) for k, t in ODD], "doc_id bigint, text string, score double, _x int")
    rows = languages.predict(df, four).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        unknown = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == unknown == (r["score"] == 0) and 0 <= r["score"] <= 1
    assert languages.predict(frame([]), four).collect() == []


def synthetic(dice, lang, count=300):
    """Words of letters that no other language has."""
    letters = "abcdefghijklmnopqrstuvwx"[4 * lang : 4 * lang + 4]
    return " ".join("".join(dice.choice(list(letters), 6)) for _ in range(count))


def test_even_mixtures_stay_in_the_pipeline(spark, frame):
    import corpus_pipeline

    dice = np.random.default_rng(5)
    rows = [(lang, synthetic(dice, lang), f"l{lang}") for lang in range(3)]
    rows += [(10, " ".join(synthetic(dice, lang) for lang in range(3)), None), (11, "123 !! 456", None), (12, None, None)]
    kept = corpus_pipeline.drop_no_language(spark, frame(rows, "doc_id bigint, text string, lang string"), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 10]


def test_mixture_of_six_languages(frame):
    dice = np.random.default_rng(6)
    model = languages.learn(frame([(synthetic(dice, lang), f"l{lang}") for lang in range(6)], "text string, lang string"))
    row = languages.predict(frame([(" ".join(synthetic(dice, lang) for lang in range(6)),)], "text string"), model).first()
    assert [x["lang"] for x in row["languages"]] == [f"l{lang}" for lang in range(6)]
    assert all(abs(x["share"] - 1 / 6) < 0.01 for x in row["languages"])


def test_no_language_learned(frame):
    none = languages.learn(frame([("x", None), (None, "y")], "lang string, text string"))
    assert none.names == []
    assert [r["lang_pred"] for r in languages.predict(frame([(1, "word")]), none).collect()] == ["und"]


def test_registered_severity_has_a_row_per_document(spark, tables):
    small = "/root/testdata/sf0.001"
    assert op4_toxicity(spark, small).count() == spark.read.parquet(f"{small}/documents.parquet").count()


def test_labels_of_other_documents_take_no_place_in_the_sample(spark, prose):
    """200 documents, half toxic, among labels of 30,000 others: the clean ones stay."""
    rows = [(n, prose(30) + (" badword nastyword" * 4 if n % 2 else "")) for n in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    own = spark.createDataFrame([(n, n % 2) for n in range(200)], "doc_id bigint, toxic int")
    others = spark.range(1000, 31_000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS toxic")
    model = toxicity.fit(docs, own.union(others), sample_rows=1000)
    kept = {r["doc_id"] for r in toxicity.without_toxic(docs, model).collect()}
    assert kept == {n for n in range(200) if n % 2 == 0}


def test_rare_toxic_documents_fill_the_sample_first(spark, prose):
    rows = [(n, prose(25) + (" badword nastyword" * 4 if n % 100 == 0 else "")) for n in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(n, int(n % 100 == 0)) for n in range(2000)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, sample_rows=100)
    scores = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert {n for n, r in scores.items() if r["rejected"]} == {n for n in range(2000) if n % 100 == 0}
    # Half of the sample is toxic, a hundredth of the documents: probabilities are of the documents.
    clean = [r["p_toxic"] for n, r in scores.items() if n % 100]
    assert sum(clean) / len(clean) < 0.05


def test_too_few_labels_reject_nothing_and_say_so(spark, prose):
    docs = spark.createDataFrame([(n, prose(20)) for n in range(30)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, int(n < 2)) for n in range(30)], "doc_id bigint, toxic int")
    with pytest.warns(UserWarning, match="2 toxic and 28 clean"):
        assert toxicity.fit(docs, labels) is None


def test_names_of_columns_are_free(spark, prose):
    rows = [(n, prose(20), "en" if n % 2 else "de", 1, 2.0) for n in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, _text int, text_ double")
    found = languages.predict(docs, languages.learn(docs))
    assert found.columns[:5] == docs.columns and found.count() == 12


ALONE = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
sys.path.insert(0, sys.argv[1])
from holdfast.llm import languages, toxicity
rows = [(n, "good words of all kinds" + (" badword nastyword" * 4 if n % 2 else " and others"), "en", n % 2) for n in range(60)]
docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, toxic int").repartition(2)
model = toxicity.fit(docs, docs.select("doc_id", "toxic"))
kept = toxicity.without_toxic(docs, model)
print("FOUND", kept.count(), toxicity.score_toxicity(docs, model).where("rejected").count(), languages.predict(kept, languages.learn(docs)).where("lang_pred = 'en'").count())
spark.stop()
"""


def test_workers_need_no_package(tmp_path):
    """The package is on the driver's path only, as on a cluster where nothing was shipped."""
    root = str(Path(__file__).parents[2])
    env = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", ALONE, root], capture_output=True, text=True, cwd=tmp_path, env=env, timeout=300)
    assert "FOUND 30 30 30" in said.stdout, said.stderr[-3000:]
