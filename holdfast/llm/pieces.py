"""SentencePiece encoding and decoding, with a max-plus parallel scan for giant documents.

Encoding is the segmentation into pieces of greatest total score.  Texts up to a size are encoded
where they are read.  A giant text is cut into chunks at fixed places, which pieces may cross:

1. every chunk yields its transfer matrix: the best score from each state at its beginning to each
   state at its end, a state being how many characters the piece across the boundary sticks out;
2. max-plus products of these matrices, which are associative, give by a parallel prefix scan the
   best scores of all states at every boundary;
3. with those, every chunk tells for each state at its end the state at its beginning that the best
   path comes from; composing these maps from the end gives the states on the best path;
4. every chunk is backtraced between its two states, independently of the others.

Places that no piece crosses (before a word, around characters of no piece) split the work inside a
chunk: words between them are segmented once and kept.  A matrix is then an outer sum.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import workspace
from .arrays import per_process, stored
from .packing import WordIds

SPACE = "▁"
ALNUM = string.ascii_letters + string.digits
CHUNK = 1 << 15
UNKNOWN_PENALTY = 10.0
NONE = float("-inf")
KEPT = 1 << 19


class Pieces(WordIds):
    """The normal pieces of a model file with their scores, and the words segmented so far.

    Scores decide, whatever algorithm the file was trained for: the pieces are read as a unigram model.
    """

    def __init__(self, path: str, most: int = KEPT) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model, self.most = SentencePieceProcessor(model_file=path), most
        model = self.model
        normal = [i for i in range(model.get_piece_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in normal}
        self.numbers = {model.id_to_piece(i): i for i in normal}
        self.longest = max(map(len, self.scores), default=1)
        # Every beginning of a piece, with its score if it is one, so that a search ends where no piece goes on.
        self.beginnings: dict[str, float | None] = {piece[:n]: None for piece in self.scores for n in range(1, len(piece))} | self.scores
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = self.bytes if model.is_byte(self.bytes[0]) else []
        # No piece crosses the place before a space mark, or a character that no piece has.
        self.space_begins = not any(SPACE in piece.lstrip(SPACE) for piece in self.scores)
        alone = "".join(re.escape(c) for c in "\n\r\t" if not any(c in piece for piece in self.scores))
        # Nor the place between a letter or digit and a mark that no piece has after one.
        inner = {piece[n : n + 2] for piece in self.scores for n in range(len(piece) - 1)}
        marks = "".join(re.escape(c) for c in string.punctuation if not any(a + c in inner for a in ALNUM))
        none = f"{SPACE}{alone}" if self.space_begins else alone
        other, begin = f"[^{none}]" if none else r"[\s\S]", f"{SPACE}+|" if self.space_begins else ""
        plain = f"[^{none}{marks}]*+" if none or marks else f"{other}*+"
        more = plain + (f"(?:(?<![A-Za-z0-9])[{marks}]{plain})*+" if marks else "")
        self.words = re.compile((f"[{alone}]|" if alone else "") + f"(?:{begin}{other}){more}")
        self.alone = set(c for c in "\n\r\t" if alone and re.fullmatch(f"[{alone}]", c))
        self.restart()

    def restart(self) -> None:
        super().restart()
        self.word_scores = np.zeros(1 << 12)

    def shrink(self) -> None:
        scores = self.word_scores[np.flatnonzero(self.uses[: len(self)] > 1)]
        super().shrink()
        self.word_scores[: len(self)] = scores[: len(self)]

    def forward(self, text: str, length: int, entry: list[float]) -> tuple[list[float], list[int]]:
        """(best score, where its last piece begins) at every place up to length + longest - 1.

        Pieces begin before `length` and may end beyond it.  `entry`: scores of the states at the
        beginning, whose back pointer is -1.  Ties keep the piece that begins first.
        """
        best = [NONE] * (max(length, len(entry)) + self.longest)
        back = [-2] * len(best)
        for place, score in enumerate(entry):
            if score > NONE:
                best[place], back[place] = score, -1
        look, total, unknown = self.beginnings.get, len(text), self.unknown
        for start in range(length):
            here = best[start]
            if here == NONE:
                continue
            end = start + 1
            score = look(text[start:end], False)
            if score is None or score is False:  # no piece of this one character
                if here + unknown > best[end]:
                    best[end], back[end] = here + unknown, start
            while score is not False:
                if score is not None and here + score > best[end]:
                    best[end], back[end] = here + score, start
                end += 1
                if end > total:
                    break
                score = look(text[start:end], False)
        return best, back

    def segmented(self, word: str) -> tuple[list[int], float]:
        """Ids and score of a word.  The same steps as `forward` from one state, as most words come here."""
        look, unknown, total = self.beginnings.get, self.unknown, len(word)
        best, back = [0.0] + [NONE] * total, [0] * (total + 1)
        for start in range(total):
            here, end = best[start], start + 1
            score = look(word[start:end], False)
            if (score is None or score is False) and here + unknown > best[end]:
                best[end], back[end] = here + unknown, start
            while score is not False:
                if score is not None and here + score > best[end]:
                    best[end], back[end] = here + score, start
                if end == total:
                    break
                end += 1
                score = look(word[start:end], False)
        parts, end = [], total
        while end:
            parts.append(word[back[end] : end])
            end = back[end]
        parts.reverse()
        ids: list[int | None] = list(map(self.numbers.get, parts))
        if None not in ids:
            return ids, best[total]
        ids = []
        for part in parts:
            if part in self.numbers:
                ids.append(self.numbers[part])
            elif self.bytes:
                ids += [self.bytes[b] for b in part.encode("utf-8", "replace")]
            elif not ids or ids[-1] != self.model.unk_id():
                ids.append(self.model.unk_id())
        return ids, best[total]

    def code(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.segmented(word) for word in words]
        first, last = len(self) - len(words), len(self)
        if last > len(self.word_scores):
            self.word_scores = np.concatenate((self.word_scores, np.zeros(max(last, len(self.word_scores)))))
        self.word_scores[first:last] = [score for _, score in found]
        return np.array([i for ids, _ in found for i in ids], np.uint32), np.array([len(ids) for ids, _ in found], np.int64)

    def marks(self, words: list[str]) -> list[bool]:
        return [False] * len(words)

    def ids_of(self, text: str) -> np.ndarray:
        """Ids of a normalised text, or of a stretch between two places on the best path."""
        return self.encode(self.words.findall(text))[0]

    def score_of(self, text: str) -> float:
        words = self.words.findall(text)
        self.encode(words)
        return float(self.word_scores[np.fromiter(map(self.__getitem__, words), np.int64, len(words))].sum())

    def is_cut(self, text: str, place: int) -> bool:
        """Whether no piece can cross this place inside the text."""
        # The marks that `words` splits off as well are left out: fewer cuts are still right.
        before, after = text[place - 1], text[place]
        return before in self.alone or after in self.alone or (self.space_begins and after == SPACE and before != SPACE)

    def cuts(self, text: str, length: int) -> tuple[int, int] | None:
        """The first cut behind all states at the beginning, and the last one before the end."""
        first = next((p for p in range(self.longest, length) if self.is_cut(text, p)), None)
        if first is None:
            return None
        return first, next(p for p in range(length - 1, first - 1, -1) if self.is_cut(text, p))

    def matrix(self, text: str, length: int) -> np.ndarray:
        """Transfer matrix of a chunk: `length` characters of `text`, the rest looks ahead."""
        size = self.longest
        found = self.cuts(text, length)
        if found is None:
            rows = []
            for state in range(size):
                entry = [NONE] * size
                entry[state] = 0.0
                rows.append(self.forward(text, length, entry)[0][length : length + size])
            return np.array(rows)
        first, last = found
        head = np.array([self.forward(text[s:first], first - s, [0.0])[0][first - s] for s in range(size)])
        tail = np.array(self.forward(text[last:], length - last, [0.0])[0][length - last : length - last + size])
        return head[:, None] + self.score_of(text[first:last]) + tail

    def origins(self, text: str, length: int, entry: list[float]) -> list[int]:
        """For each state at the end the state at the beginning that its best path comes from, or -1."""
        found = self.cuts(text, length)
        end = found[0] if found else length
        best, back = self.forward(text[:end] if found else text, end, entry)

        def origin(place: int) -> int:
            if best[place] == NONE:
                return -1
            while back[place] != -1:
                place = back[place]
            return place

        return [origin(end)] * self.longest if found else [origin(end + state) for state in range(self.longest)]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of stacks of matrices."""
    out = np.full((*a.shape[:-1], b.shape[-1]), NONE)
    for k in range(a.shape[-1]):
        np.maximum(out, a[..., :, k, None] + b[..., None, k, :], out=out)
    return out


def prefix_products(matrices: np.ndarray) -> np.ndarray:
    """All products of the first 1, 2, ... matrices, in a number of steps that is the logarithm of theirs."""
    out, step = matrices.copy(), 1
    while step < len(out):
        out = np.concatenate((out[:step], times(out[:-step], out[step:])))
        step *= 2
    return out


def _pieces(path: str) -> Pieces:
    return per_process((Pieces, path), lambda: Pieces(path))


def _decoded(pieces: Pieces, lists: pa.ListArray) -> list[str | None]:
    """Texts of lists of ids, one list at a time: Python numbers are much larger than arrays of them."""
    values, ends, known = lists.values.to_numpy(), lists.offsets.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
    return [
        pieces.model.decode(values[a:b].tolist()) if b > a and ok else "" if ok else None
        for a, b, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), known.tolist())
    ]


def _id_list(parts: list[np.ndarray]) -> pa.Array:
    sizes = np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)))



def encode(
    docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text", chunk: int = CHUNK, with_text: bool = False
) -> DataFrame:
    """(doc_id, ids), and `with_text` also the text that the ids decode to: the segmentation of greatest total score of every text, by the model file `model`.

    Texts are normalised as the file says.  Characters of no piece count as 10 below the worst piece
    and become byte pieces, or the unknown id where the file has none.  Of segmentations of equal score
    the one is taken whose last piece is longest, then the one before it, and so on.  Scores are added in double precision.

    * Null text: null ids.  Empty text: no ids.  Null ids of documents and repeated rows are kept.
    * Texts of more than `chunk` characters are scanned in parallel; their ids must fit in a row.
    * Empty table: no rows.  Only the two named columns are read.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    giant = F.coalesce(F.length("text") > chunk, F.lit(False))

    def small(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = _pieces(model)
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                texts = part.column(1).to_pylist()
                words = [pieces.words.findall(pieces.model.normalize(text)) if text else [] for text in texts]
                ids, counts, _ = pieces.encode([w for own in words for w in own])
                ends = np.r_[0, np.cumsum(counts)][np.cumsum([0, *map(len, words)])]
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)), mask=pa.array([t is None for t in texts]))
                back = [pa.array(_decoded(pieces, lists), pa.string())] if with_text else []
                yield pa.RecordBatch.from_arrays([part.column(0), lists, *back], names=["doc_id", "ids", "text"][: 2 + with_text])

    done = rows.where(~giant).mapInArrow(small, "doc_id bigint, ids array<int>" + ", text string" * with_text)
    whole = _encode_giant(rows.where(giant), model, chunk)
    return done.unionByName(decode(whole, model) if with_text else whole)


def _encode_giant(docs: DataFrame, model: str, chunk: int) -> DataFrame:
    root = workspace(docs.sparkSession)

    def chunked(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            pieces = _pieces(model)
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = pieces.model.normalize(text.as_py())
                # The last chunk may be longer, so that every chunk is longer than any piece.
                starts = list(range(0, max(1, len(whole) - chunk + 1), max(chunk, 2 * pieces.longest)))
                for number, start in enumerate(starts):
                    end = starts[number + 1] if number + 1 < len(starts) else len(whole)
                    yield pa.RecordBatch.from_pylist(
                        [{"row": row, "doc_id": key, "chunk": number, "length": end - start, "text": whole[start : end + pieces.longest]}],
                        pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int32()), ("length", pa.int32()), ("text", pa.string())]),
                    )
                row += 1

    chunks = stored(docs.mapInArrow(chunked, "row bigint, doc_id bigint, chunk int, length int, text string"), "chunks", root)
    texts = chunks.select("row", "chunk", "length", "text").repartition("row", "chunk")

    def matrices(batches):
        for batch in batches:
            pieces = _pieces(model)
            found = [pieces.matrix(t.as_py(), n).tobytes() for t, n in zip(batch.column(3), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["row", "chunk", "matrix"])

    def scanned(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        flat = [np.frombuffer(m.as_py(), np.float64) for m in rows.column("matrix")]
        size = int(round(len(flat[0]) ** 0.5))
        products = prefix_products(np.stack(flat).reshape(-1, size, size))
        start = np.full(size, NONE)
        start[0] = 0.0
        entries = [start.tolist(), *(products[:-1, 0, :]).tolist()]
        return pa.table({"row": rows.column("row"), "chunk": rows.column("chunk"), "entry": pa.array(entries, pa.list_(pa.float64()))})

    scores = stored(texts.mapInArrow(matrices, "row bigint, chunk int, matrix binary"), "matrices", root)
    entries = stored(scores.groupBy("row").applyInArrow(scanned, "row bigint, chunk int, entry array<double>"), "entries", root)

    def origins(batches):
        for batch in batches:
            pieces = _pieces(model)
            found = [pieces.origins(t.as_py(), n, e) for t, n, e in zip(batch.column(3), batch.column(2).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["row", "chunk", "origins"])

    def composed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("chunk", "descending")])
        state, out = 0, []
        for own in rows.column("origins").to_pylist():
            out.append((own[state], state))
            state = own[state]
        return pa.table({"row": rows.column("row"), "chunk": rows.column("chunk"), "first": pa.array([a for a, _ in out], pa.int32()), "last": pa.array([b for _, b in out], pa.int32())})

    came = stored(chunks.select("row", "chunk", "length", "text").join(entries, ["row", "chunk"]).mapInArrow(origins, "row bigint, chunk int, origins array<int>"), "origins", root)
    states = stored(came.groupBy("row").applyInArrow(composed, "row bigint, chunk int, first int, last int"), "states", root)

    def traced(batches):
        for batch in batches:
            pieces = _pieces(model)
            found = [pieces.ids_of(t.as_py()[a : n + b]) for t, n, a, b in zip(batch.column(4), *(batch.column(k).to_pylist() for k in (3, 5, 6)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _id_list(found)], names=["row", "doc_id", "chunk", "ids"])

    parts = chunks.select("row", "doc_id", "chunk", "length", "text").join(states, ["row", "chunk"]).select("row", "doc_id", "chunk", "length", "text", "first", "last")
    parts = parts.mapInArrow(traced, "row bigint, doc_id bigint, chunk int, ids array<int>")
    whole = parts.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    return whole.select("doc_id", F.flatten(F.col("parts.ids")).alias("ids"))


def decode(encoded: DataFrame, model: str, ids_column: str = "ids", text_column: str = "text") -> DataFrame:
    """`encoded` with the text of every row's ids; null ids give null, no ids the empty text.

    A column called `text_column` is replaced; all others pass through.
    """
    keep = [c for c in encoded.columns if c != text_column]
    at = keep.index(ids_column)

    def run(batches):
        for batch in batches:
            pieces = _pieces(model)
            texts = pa.array(_decoded(pieces, batch.column(at)), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*keep, text_column])

    schema = "".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}, " for c in keep)
    return encoded.select(*(F.col(f"`{c}`") for c in keep)).mapInArrow(run, f"{schema}`{text_column}` string")
