"""Spelling variants by permuterm rotations.

A word marked with a terminator has one rotation per place, `rest$begin`.  Two words that differ in one
replaced code point have rotations that end in that code point and are equal before it; a word that
lacks the code point has a rotation that is equal to that beginning.  So every rotation is posted whole
and without its last code point, and words that meet under one posting differ by exactly one edit.

A group holds one whole rotation at most, and otherwise words that differ in the one code point after
the common beginning, so it is no larger than the alphabet and one: no word, however frequent, makes
a hot group.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import workspace
from .arrays import stored

RUN = "[A-Za-zÀ-ÿ]+"
MARK = "$"
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
SLICE = 1 << 20
KEPT = 1 << 17
LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def text_slices(text: str, run: re.Pattern, most: int = SLICE) -> Iterator[str]:
    """The text in slices of about `most` code points that cut no run of letters."""
    first = 0
    while first < len(text):
        cut = run.match(text, first + most)
        last = cut.end() if cut else first + most
        yield text[first:last]
        first = last


def without_one(run: str, begun: int, every: int) -> str:
    """The run, less one code point where `every` divides the checksum of document and run."""
    check = zlib.crc32(run.encode(), begun)
    if check % every:
        return run
    place = check % len(run)
    return run[:place] + run[place + 1 :]


def _counted(pattern: str, min_length: int, damage: int | None) -> Callable:
    """Task: words and how often they came, told more than once where there are many."""

    def run(batches):
        find = re.compile(pattern)
        counts: Counter = Counter()

        def rows():
            batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(*batch.columns):
                begun = zlib.crc32(f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode())
                for part in text_slices(text.as_py() or "", find):
                    for word, n in Counter(find.findall(part)).items():
                        word = word.lower() if word.isascii() else word.translate(LOWER)
                        if damage:
                            word = without_one(word, begun, damage)
                        if len(word) >= min_length:
                            counts[word] += n
                    if len(counts) > KEPT:
                        yield rows()
        yield rows()

    return run


def count_words(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    pattern: str = RUN,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    damage: int | None = None,
) -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased, of `min_length` code points that came `min_count` times.

    With `damage`, a run loses code point h % length where `damage` divides h, the CRC-32 of
    `<id>:<lower-cased run>`; so the misspellings of a corpus can be made on purpose, the same each time.
    `pattern` is a class of letters, repeated.

    Null or empty texts: no words.  Null id: empty before the colon.  Repeated rows count again.
    Empty table: no rows.  Texts are read in slices; only the two named columns are read.
    """
    named = docs.select(F.col(f"`{id_column}`").cast("string").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    found = named.mapInArrow(_counted(pattern, min_length, damage), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """(key, word, n, edited, canonical): every rotation of (word, n), whole and without its last code point.

    `edited` is that code point, null for a whole rotation.  Deleting any code point of a run of
    equal ones gives the same word; only the first of the run is canonical.
    """
    turned = words.select("word", "n", F.expr("explode(sequence(0, length(word)))").alias("at"))
    whole = F.expr(f"concat(substring(word, at + 1), '{MARK}', substring(word, 1, at))")
    turned = turned.withColumn("whole", whole)
    posts = F.expr(
        """array(struct(whole AS key, CAST(NULL AS string) AS edited, true AS canonical),
                 struct(substring(whole, 1, length(whole) - 1) AS key, substring(word, at, 1) AS edited,
                        at = 1 OR substring(word, at, 1) <> substring(word, at - 1, 1) AS canonical))"""
    )
    posts = F.when(F.col("at") == 0, F.slice(posts, 1, 1)).otherwise(posts)
    return turned.select("word", "n", F.explode(posts).alias("post")).select("post.*", "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best) for words of (word, n) with a near word: how many, and the most frequent, ties by code points.

    Near: exactly one code point inserted, deleted or replaced.  Every near pair meets in one group.
    """
    member = F.struct((-F.col("n")).alias("less"), "word", F.col("edited").isNull().alias("whole"), "canonical")
    groups = rotations(words).groupBy("key").agg(F.array_sort(F.collect_list(member)).alias("members")).where(F.size("members") > 1)
    near = F.expr(
        """transform(members, m -> struct(m.word AS word, filter(members,
               o -> o.word <> m.word AND (o.whole = m.whole OR (o.canonical AND m.canonical))) AS near))"""
    )
    found = groups.select(F.explode(near).alias("m")).select("m.word", F.size("m.near").alias("n"), F.get("m.near", F.lit(0)).alias("first"))
    found = found.where("n > 0").groupBy("word").agg(F.sum("n").alias("n_near"), F.min(F.struct("first.less", "first.word")).alias("best"))
    return found.select("word", "n_near", F.struct(F.col("best.word"), (-F.col("best.less")).alias("n")).alias("best"))


def roots(forms: DataFrame, root: str) -> DataFrame:
    """(word, root) of (word, form): the last word reached by forms, by doubling the steps in each round.

    A form is at least twice as frequent as its word, so chains end and have fewer than 64 steps.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "reached-0", root)
    step = 0
    while True:
        step += 1
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(
            reached.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            f"reached-{step}",
            root,
        )
        reached = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return reached


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of (word, n), whose words are distinct.

    The form of a word is its near word of largest n, ties to the smallest in code-point order, where that n is at
    least `ratio` (2 or more) times the word's; else null.  The root is the last word that forms
    lead to, the word itself without a form.  n_near is 0 for words without a near word.

    Words must not hold the terminator `$`.  Empty table: no rows.
    """
    if ratio < 2:
        raise ValueError("with a ratio below 2 forms could go round in circles")
    root = workspace(words.sparkSession)
    words = stored(words.select("word", "n"), "words", root)
    known = words.join(neighbours(words), "word", "left")
    taken = F.when(F.col("best.n") >= ratio * F.col("n"), F.col("best"))
    known = stored(known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), taken.alias("best")), "known", root)
    ends = roots(known.where("best IS NOT NULL").select("word", F.col("best.word").alias("form")), root)
    return known.join(ends, "word", "left").select(
        "word", F.col("best.word").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("best.n").alias("form_n")
    )
