"""From raw documents to packed sequences: each stage works on what the one before it kept.

In all stages: a null or empty text is a document without words; a null doc_id is a document like others;
repeated rows are each judged alike, except that near duplicates keep one of them; other columns pass through
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import languages, line_dedup, near_duplicates, packing, toxicity
from holdfast.llm.arrays import stored


def _aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with its columns of these names called otherwise, and how to call them back."""
    clash = {name: f"_aside_{name}" for name in docs.columns if name in names}
    return docs.withColumnsRenamed(clash), {after: before for before, after in clash.items()}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose severity grade is 0; the model learns from the labels of `docs`.

    Documents without words stay.  With labels too few to learn from all documents stay, with a warning.
    """
    return toxicity.without_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_no_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, or several; learned from all of `docs`.

    Documents without a letter have none and go, also those with a null text.  Ties between languages keep the document.
    """
    aside, back = _aside(docs, ("lang_pred", "score", "languages"))
    found = languages.predict(aside, languages.learn(docs)).where(~languages.rejected())
    return found.select(*aside.columns).withColumnsRenamed(back)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines they share; n_chars follows the text.

    A shared line stays in the document of the greatest id that holds it, in all rows of that id; a null text becomes empty.
    """
    aside, back = _aside(docs, ("n_lines", "n_dropped"))
    found = line_dedup.dedup_lines(aside).select(*aside.columns).withColumnsRenamed(back)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the smallest id, null ids last, and one row of it.

    Documents without words are alike to nothing and all stay.
    """
    return near_duplicates.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids; with fewer words kept, as executors still hold memory of the stages before.

    A document without text is the one id that ends it.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), kept_words=1 << 18, slice_bytes=1 << 18)


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_no_language),
    ("line dedup", drop_shared_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("packing", pack),
]
# Learned models decide the first two stages and a tokenizer the last, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each result is written and read again, the last one is returned."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = stored(docs, f"stage-{place}")
    return docs
