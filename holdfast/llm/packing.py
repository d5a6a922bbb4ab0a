"""Order-preserving packing of tokenised documents into sequences of fixed length.

Documents keep their order: one stream of ids, each document ended by one id.  Dynamic programming
chooses where the stream is cut.  A sequence costs its padding, a cut costs what it truncates:
nothing at the end of a document, little at the end of a sentence, more inside one.  The cheapest
predecessor of a cut is a minimum over a sliding window, kept in a monotone queue, so the work is
linear in the number of possible cuts.

Every input partition is a stream of its own and is worked through in blocks of bounded size;
nothing is shuffled.  Only the last sequence of a block may be left short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import per_process, slices, text_bytes

LENGTH = 2048
END_ID = 1
SENTENCE_PENALTY = 8
INNER_PENALTY = 64
BLOCK_TOKENS = 1 << 20
KEPT_WORDS = 3 << 18
CODED_WORDS = 4096
SLICE = 1 << 20
ENDS = (b".", b"!", b"?", "。".encode(), "！".encode(), "？".encode())


ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = True
MARK = np.zeros(256, bool)
MARK[33:48] = MARK[58:65] = MARK[91:97] = MARK[123:127] = True
MARK[39] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def fewer_forms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts in fewer different words: A-Z as a-z, and a blank between a letter or digit and a mark.

    For tokenizers that lower-case and never join the two.  Left as it is: whatever holds a combining
    mark, which may compose with small letters only, or the beginning of a special token.
    """
    raw = data.tobytes()
    if b"<|" in raw or b"\xcc" in raw or b"\xcd" in raw:
        return data, offsets
    at = np.flatnonzero(ALNUM[data[:-1]] & MARK[data[1:]]) + 1
    at = at[~np.isin(at, offsets)]
    return np.insert(FOLD[data], at, 32), offsets + np.searchsorted(at, offsets)


class WordIds(dict):
    """Ids of words between ASCII blanks, each word tokenised once.

    For tokenizers to which blanks are nothing but breaks, the ids of a text are those of its
    words in a row.  Beyond `most` words, those that came in one slice are forgotten.
    """

    def __init__(self, path: str, most: int = KEPT_WORDS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.restart()

    def restart(self) -> None:
        self.clear()
        self.new: list[bytes] = []
        self.ids = np.zeros(1 << 16, np.uint32)
        self.begins = np.zeros(1 << 12, np.int64)
        self.ends_sentence = np.zeros(1 << 12, bool)
        self.uses = np.zeros(1 << 12, np.int32)

    def shrink(self) -> None:
        """Forget words that came in one slice only since the last time, or all if the others are too many."""
        keep = np.flatnonzero(self.uses[: len(self)] > 1)
        if len(keep) > self.most // 2:
            self.restart()
            return
        words = list(self)
        begins, counts = self.begins[keep], self.begins[keep + 1] - self.begins[keep]
        self.clear()
        self.update((words[k], place) for place, k in enumerate(keep.tolist()))
        ids = self.ids[ragged(begins, counts)]
        self.ids[: len(ids)] = ids
        self.begins[: len(keep) + 1] = np.r_[0, np.cumsum(counts)]
        self.ends_sentence[: len(keep)] = self.ends_sentence[keep]
        self.uses[:] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        self.new.append(word)
        return place

    def code(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has.  Few words at a time, as an encoding is large."""
        ids, counts = [], []
        for low in range(0, len(words), CODED_WORDS):
            part = [w.decode("utf-8", "replace") for w in words[low : low + CODED_WORDS]]
            coded = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(coded.ids, np.uint32))
            counts.append(np.bincount(np.array(coded.word_ids, np.int64), minlength=len(part)))
        return np.concatenate(ids), np.concatenate(counts)

    def marks(self, words: list[bytes]) -> list[bool]:
        return [w.endswith(ENDS) for w in words]

    def _learn(self) -> None:
        first, last = len(self) - len(self.new), len(self)
        ids, counts = self.code(self.new)
        if last >= len(self.begins):
            self.begins = np.concatenate((self.begins, np.zeros(max(last, len(self.begins)), np.int64)))
            self.ends_sentence = np.concatenate((self.ends_sentence, np.zeros(max(last, len(self.ends_sentence)), bool)))
            self.uses = np.concatenate((self.uses, np.zeros(max(last, len(self.uses)), np.int32)))
        at = self.begins[first]
        if at + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(ids), len(self.ids)), np.uint32)))
        self.ids[at : at + len(ids)] = ids
        self.begins[first + 1 : last + 1] = at + np.cumsum(counts)
        self.ends_sentence[first:last] = self.marks(self.new)
        self.new = []

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, number of ids by word, whether a sentence ends by word)."""
        if len(self) > self.most:
            self.shrink()
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            self._learn()
        self.uses[places] += 1
        begins, counts = self.begins[places], self.begins[places + 1] - self.begins[places]
        return self.ids[ragged(begins, counts)], counts, self.ends_sentence[places]


def ragged(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... counts[0] of them, then those of begins[1], and so on."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    steps = np.ones(total, np.int64)
    used = np.flatnonzero(counts)
    first = np.r_[0, np.cumsum(counts[used])[:-1]]
    steps[first[0]] = begins[used[0]]
    steps[first[1:]] = begins[used[1:]] - begins[used[:-1]] - counts[used[:-1]] + 1
    return np.cumsum(steps)


def choose_cuts(places: np.ndarray, penalties: np.ndarray, length: int) -> list[int]:
    """The cheapest cuts of a stream.  `places`: possible cuts, ascending, with 0 first and the end last.

    A sequence is padded to `length`, except at a power of two.  Two neighbours are at most
    `length` apart.  Ties go to the earlier predecessor in the queue.
    """
    shortcuts: dict[int, list[int]] = {}
    number = np.full(int(places[-1]) + 1, -1, np.int32)
    number[places] = np.arange(len(places), dtype=np.int32)
    power = 1
    while power < length:
        begin = int(np.searchsorted(places, power))
        sources = number[places[begin:] - power]
        hits = np.flatnonzero(sources >= 0)
        for j, i in zip((hits + begin).tolist(), sources[hits].tolist()):
            shortcuts.setdefault(j, []).append(i)
        power *= 2
    spots, costs = places.tolist(), penalties.tolist()
    best, sums, back = [0], [spots[0]], [0]
    queue, head = [0], 0
    for j in range(1, len(spots)):
        spot = spots[j]
        while spots[queue[head]] < spot - length:
            head += 1
        source = queue[head]
        value = sums[source] + length - spot
        if j in shortcuts:
            for i in shortcuts[j]:
                if best[i] < value:
                    value, source = best[i], i
        value += costs[j]
        best.append(value)
        back.append(source)
        value += spot
        sums.append(value)
        while len(queue) > head and sums[queue[-1]] > value:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(spots) - 1
    while j:
        cuts.append(spots[j])
        j = back[j]
    return cuts[::-1]


def possible_cuts(ends: np.ndarray, sentences: np.ndarray, total: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where documents or sentences end, and finer ones inside long gaps, with penalties."""
    step = max(1, length // 64)
    spots = np.unique(np.concatenate(([0, total], ends, sentences)).astype(np.int64))
    gaps = np.flatnonzero(np.diff(spots) > length // 8)
    inner = [np.arange(spots[g] + step, spots[g + 1], step) for g in gaps.tolist()]
    spots = np.unique(np.concatenate([spots, *inner]))
    costs = np.full(len(spots), INNER_PENALTY, np.int64)
    costs[np.searchsorted(spots, sentences)] = SENTENCE_PENALTY
    costs[np.searchsorted(spots, ends)] = 0
    costs[[0, -1]] = 0
    return spots, costs


class Block:
    """A stretch of one partition's stream."""

    def __init__(self) -> None:
        self.ids, self.sentences, self.rows, self.total = [], [], [], 0

    def add(self, doc: object, ids: np.ndarray, sentences: np.ndarray, start: int, doc_tokens: int) -> None:
        self.rows.append((doc, self.total, len(ids), start, doc_tokens))
        self.ids.append(ids)
        self.sentences.append(sentences + self.total)
        self.total += len(ids)

    def packed(self, length: int, sequence: int) -> tuple[dict[str, list], list[np.ndarray], int]:
        """Columns of the pieces, their ids, and the number of sequences."""
        ids = np.concatenate(self.ids)
        ends = np.array([begin + count for _, begin, count, _, _ in self.rows], np.int64)
        cuts = choose_cuts(*possible_cuts(ends, np.concatenate(self.sentences), self.total, length), length)
        out: dict[str, list] = {name: [] for name in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")}
        pieces, row, low = [], 0, 0
        for number, high in enumerate(cuts):
            at = low
            while at < high:
                doc, begin, count, start, doc_tokens = self.rows[row]
                stop = min(high, begin + count)
                values = (doc, start + at - begin, stop - at, doc_tokens, sequence + number, at - low)
                for column, value in zip(out.values(), values):
                    column.append(value)
                pieces.append(ids[at:stop])
                at = stop
                row += stop == begin + count
            low = high
        return out, pieces, len(cuts)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    digest: bool = False,
    lower_case: bool = True,
    block_tokens: int = BLOCK_TOKENS,
    kept_words: int = KEPT_WORDS,
    slice_bytes: int = SLICE,
) -> DataFrame:
    """Pieces of packed sequences: doc_id, start, length, doc_tokens, sequence_id, offset, and ids.

    A document is the ids of its text by the tokenizer file `tokenizer` (one for which ASCII blanks
    only separate), without added special tokens, then `end_id`.  Each id lies in one piece: `start`
    ids of its document come before it, and it begins at `offset` of its sequence.  Sequences hold
    at most `length` ids and keep the stored order of `docs`; read them from a table, so that a task
    that runs again sees the same rows.  `lower_case`: the tokenizer lower-cases and splits letters and
    digits from marks, so forms of a word are tokenised once.  `kept_words` and `slice_bytes` trade a
    worker's memory for time and change no result.  `digest` gives the CRC-32 of the ids as little-endian
    32-bit numbers (ids_crc32) in place of the ids.

    * Null or empty text: `end_id` alone.  Null doc_id: packed like others.  Repeated rows are
      separate documents.  Empty table: no rows.  A text longer than a block goes over several.
    * Only the two named columns are read.
    """
    last = "ids_crc32" if digest else "ids"

    def run(batches) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32
        block = Block()

        def emit() -> pa.RecordBatch:
            nonlocal block, sequence
            columns, pieces, count = block.packed(length, sequence)
            sequence += count
            block = Block()
            if digest:
                ids = pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in pieces], pa.int64())
            else:
                sizes = np.r_[0, np.cumsum([len(p) for p in pieces])].astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(pieces).astype(np.int32)))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns.values()), ids], names=[*columns, last])

        for batch in batches:
            coder: WordIds = per_process((WordIds, tokenizer, kept_words), lambda: WordIds(tokenizer, kept_words))
            data, offsets = text_bytes(batch.column(1))
            keys = batch.column(0).to_pylist()
            for low, high in slices(offsets, slice_bytes):
                own, at = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                if lower_case:
                    own, at = fewer_forms(own, at)
                words = [own[a:b].tobytes().split() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                ids, counts, marks = coder.encode([w for own in words for w in own])
                after = np.cumsum(counts)
                word = token = 0
                for k, own in enumerate(words):
                    word_end = word + len(own)
                    token_end = int(after[word_end - 1]) if word_end else 0
                    whole = np.empty(token_end - token + 1, np.uint32)
                    whole[:-1], whole[-1] = ids[token:token_end], end_id
                    stops = after[word:word_end][marks[word:word_end]] - token
                    start = 0
                    while start < len(whole):
                        stop = min(len(whole), start + block_tokens - block.total)
                        inside = stops[(stops > start) & (stops <= stop)] - start
                        block.add(keys[low + k], whole[start:stop], inside, start, len(whole))
                        start = stop
                        if block.total >= block_tokens:
                            yield emit()
                    word, token = word_end, token_end
        if block.total:
            yield emit()

    kinds = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    texts = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    return texts.mapInArrow(run, f"{kinds}, {last} {'bigint' if digest else 'array<int>'}")
