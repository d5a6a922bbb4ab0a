"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(w.x - t[k]) with t ascending: one weight per feature serves all thresholds.
Features are the presence of words and word beginnings, hashed, and the rate of words that speak for
toxicity.  The labels are 0 or 1; grades order the toxic ones by that rate (thirds of the labelled
toxic documents), so grade 0 is clean, 1 mild and 3 severe.

The model is fitted on a sample of bounded size (`sample_rows`) of the labelled documents that there
are: toxic ones first, up to half of it, then clean ones, each chosen by a hash of the id.  The thresholds
are moved by the logarithm of how much more often toxic ones were taken, which undoes that choice.
Every document is then scored where it is read; no text is shuffled.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import workspace
from .arrays import SpanHasher, slices, stored, text_bytes, word_spans

SAMPLE_ROWS = 20_000
BUCKETS = 1 << 20
FEATURES = 4096
BEGINNINGS = (5, 6, 7, 8)
MIN_COUNT = 3
GRADES = 4
Z_FEATURE = 3.0
Z_SIGN = 4.0
SIGN_SHARE = 0.8
ROUNDS = 400
RIDGE = 1e-3
THRESHOLD = 0.5

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of every word: itself and its beginnings, by column; where each text's words begin)."""
    starts, ends, places = word_spans(data, offsets, ~LETTER)
    hasher = SpanHasher(data)
    columns = [hasher(starts, ends)]
    for size in BEGINNINGS:
        # The length goes into the hash, so a beginning and a word of the same letters differ.
        columns.append(hasher(starts, np.minimum(starts + size, ends)) + np.uint64(size))
    hashed = np.stack(columns, axis=1)
    short = (ends - starts)[:, None] <= np.array([0, *BEGINNINGS])
    short[:, 0] = False
    out = (hashed & np.uint64(buckets - 1)).astype(np.int64)
    out[short] = -1
    return out, places


@dataclass
class Model:
    """weights: by bucket, the rate's weight apart; signs: buckets that speak for toxicity."""

    buckets: int
    chosen: np.ndarray
    weights: np.ndarray
    signs: np.ndarray
    rate_weight: float
    thresholds: np.ndarray


def feature_table(buckets: int, chosen: np.ndarray) -> np.ndarray:
    """For every bucket the number of its feature, or -1."""
    out = np.full(buckets + 1, -1, np.int32)
    out[chosen] = np.arange(len(chosen), dtype=np.int32)
    return out


def _encode(data, offsets, table, signs, buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text and feature numbers of what is present, share of words with a sign, words) of a slice."""
    found, places = features(data, offsets, buckets)
    numbers = table[found]
    word, column = np.nonzero(numbers >= 0)
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(places))
    hit = numbers[word, column]
    pairs = np.unique(text_of[word].astype(np.int64) << 32 | hit)
    marked = np.zeros(len(found), np.int64)
    marked[word[signs[hit]]] = 1
    words = np.diff(places)
    hits = np.bincount(text_of, marked, minlength=len(words))
    return pairs >> 32, pairs & 0xFFFFFFFF, np.log1p(200 * hits / (words + 50)), words


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, rates: np.ndarray, grades: np.ndarray, n_features: int, rounds: int = ROUNDS, ridge: float = RIDGE):
    """Weights, the rate's weight and ascending thresholds of greatest penalised likelihood (Adam, whole batch).

    Thresholds are the first one plus sums of positive steps.
    """
    n, levels = len(grades), int(grades.max()) if len(grades) else 0
    levels = max(levels, 1)
    x = np.zeros(n_features + 1 + levels)
    x[n_features + 1] = 2.0
    first, second = np.zeros_like(x), np.zeros_like(x)
    above = grades[:, None] > np.arange(levels)[None, :]
    for step in range(1, rounds + 1):
        weights, rate, raw = x[:n_features], x[n_features], x[n_features + 1 :]
        steps = np.exp(raw[1:])
        thresholds = raw[0] + np.r_[0.0, np.cumsum(steps)]
        score = np.bincount(rows, weights[columns], minlength=n) + rate * rates
        tail = np.c_[np.ones(n), sigmoid(score[:, None] - thresholds), np.zeros(n)]
        own = np.maximum(tail[np.arange(n), grades] - tail[np.arange(n), grades + 1], 1e-9)
        slope = tail[:, 1:-1] * (1 - tail[:, 1:-1])
        # The likelihood of grade g is tail[g] - tail[g + 1]; columns of `slope` are tails 1, 2, ...
        part = np.zeros((n, levels))
        is_low = np.arange(levels)[None, :] == grades[:, None] - 1
        is_high = np.arange(levels)[None, :] == grades[:, None]
        part[is_low] = slope[is_low]
        part[is_high] -= slope[is_high]
        by_level = part / own[:, None]
        by_score = by_level.sum(axis=1)
        by_threshold = -by_level.sum(axis=0)
        gradient = np.r_[
            np.bincount(columns, by_score[rows], minlength=n_features) / n - ridge * weights,
            (by_score * rates).sum() / n,
            by_threshold.sum() / n,
            steps * np.cumsum(by_threshold[::-1])[::-1][1:] / n,
        ]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        x += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    raw = x[n_features + 1 :]
    return x[:n_features], float(x[n_features]), raw[0] + np.r_[0.0, np.cumsum(np.exp(raw[1:]))]


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS
) -> Model | None:
    """A model from at most `sample_rows` labelled documents of `docs`; None, with a warning, where fewer than
    MIN_COUNT of either kind are labelled, as nothing could be learned.

    An id with several labels counts as toxic if one says so.  Null labels and ids are left out, and so are labels
    of other documents.  The most that reaches the driver is one row per bucket and one per sampled document.
    """
    root = workspace(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    known = labels.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{label_column}`").cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic")).join(texts.select("id"), "id", "left_semi")
    known = stored(known, "labelled", root)
    there = {row["toxic"]: row["n"] for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    all_clean, all_bad = there.get(0, 0), there.get(1, 0)
    if min(all_clean, all_bad) < MIN_COUNT:
        warnings.warn(f"toxicity: {all_bad} toxic and {all_clean} clean documents are labelled, too few to learn from; nothing will be rejected")
        return None
    bad = min(all_bad, max(sample_rows // 2, sample_rows - all_clean))
    clean = min(all_clean, sample_rows - bad)
    wanted = reduce(DataFrame.union, [known.where(F.col("toxic") == kind).orderBy(F.xxhash64("id"), "id").limit(n) for kind, n in ((0, clean), (1, bad))])
    # Broadcast is bounded by the limits above.
    sample = stored(texts.join(F.broadcast(wanted), "id").select("id", "text", "toxic").dropDuplicates(["id"]), "sample", root)

    def counted(batches):
        seen, toxic = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            marks = batch.column(1).to_numpy(zero_copy_only=False)
            for low, high in slices(offsets):
                begin, end = offsets[low], offsets[high]
                found, places = features(data[begin:end], offsets[low : high + 1] - begin, buckets)
                for k in range(high - low):
                    own = np.unique(found[places[k] : places[k + 1]])
                    own = own[own >= 0]
                    seen[own] += 1
                    if marks[low + k] > 0:
                        toxic[own] += 1
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[used]), pa.array(toxic[used])], names=["bucket", "seen", "toxic"])

    counts = sample.select("text", "toxic").mapInArrow(counted, "bucket bigint, seen bigint, toxic bigint")
    counts = counts.groupBy("bucket").agg(F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic")).where(F.col("seen") >= MIN_COUNT).toPandas()
    seen, hits = counts["seen"].to_numpy(float), counts["toxic"].to_numpy(float)
    odds = np.log((hits + 0.5) / (bad - hits + 0.5)) - np.log((seen - hits + 0.5) / (clean - seen + hits + 0.5))
    weight = odds / np.sqrt(1 / (hits + 0.5) + 1 / (seen - hits + 0.5))
    order = np.lexsort((counts["bucket"], -np.abs(weight)))[:FEATURES]
    order = order[np.abs(weight[order]) > Z_FEATURE]
    chosen = counts["bucket"].to_numpy(np.int64)[order]
    signs = (weight[order] > Z_SIGN) & (hits[order] >= SIGN_SHARE * seen[order])
    model = Model(buckets, chosen, np.zeros(len(chosen)), signs, 0.0, np.zeros(1))
    encoded = _scan(sample.select("id", "text", "toxic"), model, None).toPandas()
    sizes = encoded["features"].map(len).to_numpy(np.int64) if len(encoded) else np.zeros(0, np.int64)
    rows = np.repeat(np.arange(len(encoded)), sizes)
    columns = np.concatenate([np.asarray(x, np.int64) for x in encoded["features"]]) if len(encoded) else np.zeros(0, np.int64)
    rates = encoded["rate"].to_numpy(float)
    grades = (encoded["toxic"].to_numpy() > 0).astype(np.int64)
    edges = np.quantile(rates[grades > 0], np.arange(1, GRADES - 1) / (GRADES - 1))
    grades[grades > 0] += np.searchsorted(edges, rates[grades > 0], side="left")
    model.weights, model.rate_weight, thresholds = fit_ordinal(rows, columns, rates, grades, len(chosen))
    model.thresholds = thresholds + np.log((bad / all_bad) / (clean / all_clean))
    return model


def _scan(docs: DataFrame, model: Model, others: list[str] | None) -> DataFrame:
    """Features of (id, text, toxic) rows, or with `others` the scores of (..., text) rows without the text."""
    training = others is None
    # As plain arrays: workers need no class of this package.
    held = docs.sparkSession.sparkContext.broadcast(vars(model))
    text_at = docs.columns.index("text")

    def run(batches):
        model = SimpleNamespace(**held.value)
        table = feature_table(model.buckets, model.chosen)
        for batch in batches:
            data, offsets = text_bytes(batch.column(text_at))
            n = batch.num_rows
            scores, rates, words, present = np.zeros(n), np.zeros(n), np.zeros(n, np.int64), []
            for low, high in slices(offsets):
                begin, end = offsets[low], offsets[high]
                text, feature, rate, count = _encode(data[begin:end], offsets[low : high + 1] - begin, table, model.signs, model.buckets)
                rates[low:high], words[low:high] = rate, count
                scores[low:high] = np.bincount(text, model.weights[feature], minlength=high - low) + model.rate_weight * rate
                if training:
                    present += [part.tolist() for part in np.split(feature, np.searchsorted(text, np.arange(1, high - low)))]
            if training:
                yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(rates), pa.array(present, pa.list_(pa.int32()))], names=["toxic", "rate", "features"])
                continue
            tail = sigmoid(scores[:, None] - model.thresholds) * (words > 0)[:, None]
            grade = (tail >= THRESHOLD).sum(axis=1)
            kept = [batch.column(k) for k in range(batch.num_columns) if k != text_at]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(grade.astype(np.int32)), pa.array(tail.sum(axis=1)), pa.array(tail[:, 0]), pa.array(grade > 0)],
                names=[*others, "grade", "expected_severity", "p_toxic", "rejected"],
            )

    if training:
        return docs.mapInArrow(run, "toxic int, rate double, features array<int>")
    schema = "".join(f"`{name}` {docs.schema[name].dataType.simpleString()}, " for name in others)
    return docs.mapInArrow(run, f"{schema}grade int, expected_severity double, p_toxic double, rejected boolean")


def score_toxicity(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, grade, expected_severity, p_toxic, rejected) for every row.

    p_toxic is P(grade > 0), the grade is the number of thresholds passed with at least even chance,
    the expected severity the sum of all P(grade > k), from 0 to the highest grade; `rejected` means
    a grade above 0.  Null or wordless text, or no model: grade 0, severity 0.  Null ids, repeated
    rows and long texts are scored like others; an empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0).alias("grade"), F.lit(0.0).alias("expected_severity"), F.lit(0.0).alias("p_toxic"), F.lit(False).alias("rejected"))
    return _scan(rows, model, ["doc_id"])


def without_toxic(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """The rows of `docs` that are not rejected, all columns as they are."""
    if model is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast(vars(model))
    text_at = docs.columns.index(text_column)

    def run(batches):
        model = SimpleNamespace(**held.value)
        table = feature_table(model.buckets, model.chosen)
        for batch in batches:
            data, offsets = text_bytes(batch.column(text_at))
            keep = np.ones(batch.num_rows, bool)
            for low, high in slices(offsets):
                begin, end = offsets[low], offsets[high]
                text, feature, rate, count = _encode(data[begin:end], offsets[low : high + 1] - begin, table, model.signs, model.buckets)
                score = np.bincount(text, model.weights[feature], minlength=high - low) + model.rate_weight * rate
                keep[low:high] = (sigmoid(score - model.thresholds[0]) < THRESHOLD) | (count == 0)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
