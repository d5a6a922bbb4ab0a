"""The stages against plain Python on a fixture, and the whole on given tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_near_duplicates import brute_force

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, n_lines int"


@pytest.fixture(scope="module")
def stages():
    return dict(corpus_pipeline.STAGES)


def test_order_of_stages(stages):
    assert list(stages) == ["toxicity", "language ID", "line dedup", "n-gram Jaccard join", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_the_stages_one_by_one(spark, stages):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        if name != "packing":
            assert docs.columns == columns
        docs = docs.cache()
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] == counts[3] > counts[4]
    run = corpus_pipeline.run(spark, FOLDER)
    of = lambda df: {tuple(r) for r in df.groupBy("doc_id").agg(F.sum("length"), F.max("doc_tokens")).collect()}
    assert of(run) == of(docs)


def test_stages_against_brute_force(spark, frame, stages, prose):
    shared = "Read the terms of use before you go on reading this page."
    rows = [(k, f"{prose(80)}\n{shared}", "en", "s", 0, k, None) for k in range(8)]
    rows += [(20 + k, rows[k][1].replace("\n", " \n"), None, None, None, 5, 6) for k in range(4)]
    rows += [(40, None, None, "s", 0, 1, 1), (41, "", "en", None, 0, 1, 1), (None, rows[0][1], "en", "s", 0, 9, 9), (6, rows[6][1], "en", "s", 0, 6, None), (60, prose(20_000), "en", "s", 0, 0, 0)]
    docs = frame(rows, SCHEMA)

    lines = stages["line dedup"](spark, docs, FOLDER)
    assert lines.columns == docs.columns
    seen = {}
    for row in rows:
        for line in set((row[1] or "").split("\n")):
            if len(line.strip()) >= 40 and row[0] is not None:
                seen.setdefault(line.strip().lower(), set()).add(row[0])
    gone = {line: max(ids) for line, ids in seen.items() if len(ids) >= 5}
    expected = []
    for row in rows:
        kept = [line for line in (row[1] or "").split("\n") if gone.get(line.strip().lower(), row[0]) == row[0] or line.strip().lower() not in gone]
        expected.append((row[0], "\n".join(kept), len("\n".join(kept)), row[5]))
    got = [(r["doc_id"], r["text"], r["n_chars"], r["score"]) for r in lines.collect()]
    assert gone and sorted(got, key=repr) == sorted(expected, key=repr)

    kept = stages["n-gram Jaccard join"](spark, lines, FOLDER)
    texts = [(key, text) for key, text, _, _ in expected]
    classes = {}
    for (key, text), (_, n, component) in zip(texts, brute_force(texts)):
        classes.setdefault(component if n else ("empty", len(classes)), []).append(key)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((min(x for x in ids if x is not None) for ids in classes.values()), key=repr)

    packed = stages["packing"](spark, kept, FOLDER).collect()
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in kept.collect():
        pieces = sorted((p for p in packed if p["doc_id"] == r["doc_id"]), key=lambda p: p["start"])
        assert [i for p in pieces for i in p["ids"]] == [*coder.encode(r["text"] or "", add_special_tokens=False).ids, 1]


def test_filters_keep_clean_documents(spark, stages):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    kept = stages["toxicity"](spark, docs, "/root/testdata/sf0.1")
    after = {r["toxic"]: r["n"] for r in kept.join(labels, "doc_id").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    before = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    assert after[0] >= 0.99 * before[0] and after.get(1, 0) <= 0.15 * before[1]
    known = docs.where("lang IS NOT NULL").count()
    assert stages["language ID"](spark, docs, "").where("lang IS NOT NULL").count() >= 0.999 * known


def test_odd_tables(spark, frame, stages):
    rows = [(1, None, None, None, None, None, None), (None, "", None, None, None, None, None), (2, "12 34", "en", "s", 5, 1, 1)]
    for docs in (frame([], SCHEMA), frame(rows, SCHEMA)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            assert docs.count() == (0 if name in ("language ID", "line dedup", "n-gram Jaccard join", "packing") else docs.count())
