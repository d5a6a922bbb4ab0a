"""Languages of documents as mixtures: expectation-maximisation over n-gram likelihoods.

A word's likelihood in a language is the product of smoothed frequencies of its byte n-grams, which
Spark counts over all labelled documents.  A document is a mixture: every word is drawn from one of
its languages, and the proportions are estimated by expectation-maximisation.  The set of languages
is the one of greatest likelihood less a penalty per language that grows with the logarithm of the
number of words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import SLICE_BYTES, mix, slices, text_bytes, unused, word_spans

BUCKETS = 1 << 16
GRAM = 4
SMOOTHING = 0.5
ROUNDS = 12
PENALTY = 3.0
UNKNOWN = "und"

MAYBE_LETTER = re.compile(r"[^\W\d_]")
FOLD = np.arange(256, dtype=np.uint64)
FOLD[65:91] += 32
FOLD[9:14] = 32
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def has_letter(text: str | None) -> bool:
    return bool(text) and any(found.group().isalpha() for found in MAYBE_LETTER.finditer(text))


def gram_buckets(data: np.ndarray, buckets: int) -> np.ndarray:
    """For every byte the bucket of the n-gram that ends there; A-Z as a-z, all blanks alike."""
    folded = FOLD[data]
    gram = folded.copy()
    for back in range(1, GRAM):
        gram[back:] |= folded[:-back] << np.uint64(8 * back)
        gram[:back] |= np.uint64(32) << np.uint64(8 * back)
    return (mix(gram) & np.uint64(buckets - 1)).astype(np.int64)


def _in_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text) of the words that have a letter; an end takes the blank after the word along."""
    starts, ends, places = word_spans(data, offsets)
    letters = np.r_[0, np.cumsum(LETTER[data])]
    keep = letters[ends] > letters[starts]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(places))
    return starts[keep], np.minimum(ends + 1, offsets[1:][text])[keep], text[keep]


@dataclass
class Languages:
    """names, ascending, and by bucket the log of each language's share."""

    names: list[str]
    logs: np.ndarray


def learn(docs: DataFrame, lang_column: str = "lang", text_column: str = "text", buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> Languages:
    """n-gram frequencies of every language in `docs`; rows without text or language teach nothing.

    All rows are counted.  What reaches the driver is a row per language and bucket.
    """

    def counted(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            data, offsets = text_bytes(batch.column(1))
            for low, high in slices(offsets):
                begin, end = offsets[low], offsets[high]
                part, places = data[begin:end], offsets[low : high + 1] - begin
                grams = gram_buckets(part, buckets)
                starts, ends, text = _in_words(part, places)
                inside = np.zeros(len(part) + 1, np.int64)
                inside[starts] += 1
                inside[ends] -= 1
                inside = np.cumsum(inside[:-1]) > 0
                own = np.array(langs[low:high], object)
                for lang in {x for x in own if x is not None}:
                    mine = inside & np.repeat(own == lang, np.diff(places))
                    counts.setdefault(lang, np.zeros(buckets, np.int64))
                    counts[lang] += np.bincount(grams[mine], minlength=buckets)
        for lang, own in counts.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(own[used])], names=["lang", "bucket", "count"])

    rows = docs.select(F.col(f"`{lang_column}`").cast("string").alias("lang"), F.col(f"`{text_column}`").cast("string").alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(counted, "lang string, bucket bigint, count bigint")
    found = rows.groupBy("lang", "bucket").agg(F.sum("count").alias("count")).toPandas()
    names = sorted(found["lang"].unique())
    table = np.zeros((buckets, len(names)))
    table[found["bucket"].to_numpy(np.int64), np.searchsorted(names, found["lang"].to_numpy(object).astype(str)) if names else []] = found["count"]
    table += smoothing
    return Languages(names, np.log(table / table.sum(axis=0)))


def _em(likelihood: np.ndarray, text: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of every text, over its allowed languages.

    likelihood: one row per word, the greatest of a row being 1; first: each text's first word.
    """
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    words = np.diff(np.r_[first, len(likelihood)])[:, None]
    for _ in range(rounds):
        joint = likelihood * shares[text]
        total = np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)
        shares = np.add.reduceat(joint / total, first, axis=0) / words
    total = np.log(np.maximum((likelihood * shares[text]).sum(axis=1), 1e-300))
    return shares, np.add.reduceat(total, first)


def mixtures(data: np.ndarray, offsets: np.ndarray, model: Languages, rounds: int, penalty: float) -> np.ndarray:
    """Language proportions of every text of a slice, 0 outside its chosen set; all 0 without a word."""
    out = np.zeros((len(offsets) - 1, len(model.names)))
    starts, ends, text = _in_words(data, offsets)
    if not len(starts):
        return out
    sums = np.zeros((len(data) + 1, len(model.names)))
    np.cumsum(model.logs[gram_buckets(data, len(model.logs))], axis=0, out=sums[1:])
    logs = sums[ends] - sums[starts]
    likelihood = np.exp(logs - logs.max(axis=1, keepdims=True))
    used, first, number = np.unique(text, return_index=True, return_inverse=True)
    words = np.diff(np.r_[first, len(text)])
    everything = np.ones((len(used), len(model.names)))
    shares, together = _em(likelihood, number, first, everything, rounds)
    order = np.argsort(np.argsort(-shares, axis=1, kind="stable"), axis=1, kind="stable")
    price = penalty * np.log(words + 1)
    best, alone = _em(likelihood, number, first, (order < 1).astype(float), 1)
    # Several languages can pay only where all of them together gain more than the price of one.
    mixed = np.flatnonzero(together - alone > price)
    if len(mixed):
        rows = np.isin(number, mixed)
        likelihood, first = likelihood[rows], np.r_[0, np.cumsum(words[mixed])[:-1]]
        number, price, value = np.repeat(np.arange(len(mixed)), words[mixed]), price[mixed], alone[mixed] - price[mixed]
        for size in range(2, len(model.names) + 1):
            # No gain is above 0, as the greatest likelihood of a word is 1.
            if (-size * price <= value).all():
                break
            own, gain = _em(likelihood, number, first, (order[mixed] < size).astype(float), rounds)
            better = gain - size * price > value
            best[mixed[better]], value[better] = own[better], (gain - size * price)[better]
    out[used] = best
    return out


def predict(
    docs: DataFrame,
    model: Languages,
    text_column: str = "text",
    keep: list[str] | None = None,
    rounds: int = ROUNDS,
    penalty: float = PENALTY,
) -> DataFrame:
    """The columns `keep` (default: all), then lang_pred, score, and the chosen languages with their proportions.

    lang_pred is the language of the greatest proportion, ties to the first by name; score is that
    proportion.  Null text, a text without a letter, or a model of no language: `und`, score 0, no
    languages.  Columns of `docs` named like an output are replaced.
    """
    added = ("lang_pred", "score", "languages")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    # As plain values: workers need no class of this package.
    held = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        model = SimpleNamespace(**held.value)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            texts = batch.column(0).to_pylist()
            names, scores, sets = [], [], []
            for low, high in slices(offsets, 4 * SLICE_BYTES // max(4, len(model.names))):
                begin, end = offsets[low], offsets[high]
                shares = mixtures(data[begin:end], offsets[low : high + 1] - begin, model, rounds, penalty) if model.names else None
                for k in range(high - low):
                    own = shares[k] if shares is not None and has_letter(texts[low + k]) else None
                    if own is None or not own.any():
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        sets.append([])
                        continue
                    top = int(np.argmax(own))
                    names.append(model.names[top])
                    scores.append(float(min(1.0, own[top])))
                    sets.append([{"lang": model.names[j], "share": float(own[j])} for j in np.flatnonzero(own > 0)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                names=[*keep, *added],
            )

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    # Batches come by place, so the text's name must only differ from those kept.
    texts = docs.select(F.col(f"`{text_column}`").cast("string").alias(unused("text", keep)), *(F.col(f"`{c}`") for c in keep))
    return texts.mapInArrow(run, f"{kinds}lang_pred string, score double, languages array<struct<lang: string, share: double>>")


def held_out(id_column: str = "doc_id") -> Column:
    """Documents that teach nothing: crc32 of the id as text leaves 1 when divided by 3.  Null ids teach."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def rejected() -> Column:
    """No language at all; a mixture is kept however its words are shared out."""
    return F.col("lang_pred") == UNKNOWN
