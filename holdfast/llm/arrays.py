"""Whole Arrow batches of texts as NumPy arrays: bytes, words, hashes.

A batch is worked on in slices of bounded bytes, so the temporary arrays stay small whatever the
batch holds; only a single text longer than the slice makes a larger one.
"""

from __future__ import annotations

import sys
import threading
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import workspace

SLICE_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_codes() -> np.ndarray:
    """One random word per byte value; A-Z have those of a-z."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
    codes[65:91] = codes[97:123]
    return codes


CODES = byte_codes()
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    out[1:] = base
    np.multiply.accumulate(out, out=out)
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the n + 1 places where they begin.  Null: no bytes."""
    if column.null_count == len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes together, one text at least.

    At the end Arrow gives unused memory back, as a worker lives on beside those of later stages.
    """
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last
    pa.default_memory_pool().release_unused()


def word_spans(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where every word of every text begins and ends, and the n + 1 places where each text's words begin.

    Words are runs of bytes that `blank` does not mark; no word goes over the end of its text.
    """
    n = len(data)
    words = np.zeros(n + 1, bool)
    words[:n] = ~blank[data]
    before = np.zeros(n + 1, bool)
    before[1:] = words[:n]
    begins_text = np.zeros(n + 1, bool)
    begins_text[offsets] = True
    starts = np.flatnonzero(words & (~before | begins_text))
    ends = np.flatnonzero(before & (~words | begins_text))
    return starts, ends, np.searchsorted(starts, offsets)


class SpanHasher:
    """64-bit hashes of stretches of bytes, A-Z as a-z, from running sums."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(CODES[data] * powers(BASE, len(data))[:-1], out=self.sums[1:], dtype=np.uint64)
            self.inverse = powers(BASE_INVERSE, len(data))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            found = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
            return mix(found + (ends - starts).astype(np.uint64) * BASE)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word (runs of bytes other than space and 0x09-0x0D), and where each text's words begin."""
    starts, ends, places = word_spans(data, offsets)
    return SpanHasher(data)(starts, ends), places


def unused(name: str, columns: list[str]) -> str:
    """`name`, with as many underscores before it as it takes to be none of the columns, whatever their case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stored(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Write a table to the shared folder and go on from its files."""
    path = f"{root or workspace(df.sparkSession)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _forget(kept: dict, key: object) -> None:
    kept.pop(key, None)
    pa.default_memory_pool().release_unused()


def per_process(key: object, make: Callable[[], object], idle: float = 15.0) -> object:
    """`make()`, kept for later tasks of the same Python worker until it was not asked for some seconds."""
    kept = sys.modules.setdefault("holdfast_kept", types.ModuleType("holdfast_kept")).__dict__
    value, timer = kept.pop(key, (None, None))
    if timer:
        timer.cancel()
    if value is None:
        value = make()
    timer = threading.Timer(idle, _forget, (kept, key))
    timer.daemon = True
    kept[key] = value, timer
    timer.start()
    return value
