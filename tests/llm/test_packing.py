import itertools
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from holdfast.llm.packing import choose_cuts, pack, ragged

MODEL = public_tokenizers.path("word_bpe_49k.json")


def check(rows, found, length):
    """Every id in one piece, sequences gapless and of at most `length` ids."""
    coder = Tokenizer.from_file(MODEL)
    by_sequence, by_doc = {}, {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda r: r["offset"]):
            assert piece["offset"] == at and piece["length"] == len(piece["ids"]) > 0
            at += piece["length"]
        assert at <= length
    wanted = sorted((str(key), [*coder.encode(text or "", add_special_tokens=False).ids, 1]) for key, text in rows)
    got = []
    for (key, total), pieces in by_doc.items():
        ids = {}
        for piece in pieces:
            for k, value in enumerate(piece["ids"]):
                ids.setdefault(piece["start"] + k, []).append(value)
        assert sorted(ids) == list(range(total))
        copies = len(ids[0])
        got += [(str(key), [ids[k][0] for k in range(total)])] * copies
    assert sorted(got) == wanted
    return by_sequence


def test_round_trip_and_edges(frame, prose):
    dice = random.Random(5)
    rows = [(key, ". ".join(prose(dice.randrange(1, 40)) for _ in range(dice.randrange(1, 12)))) for key in range(40)]
    rows += [(100, None), (101, ""), (102, " \n"), (None, "no id"), (103, "twice"), (103, "twice"), (104, prose(9000)), (105, "x" * 50_000), (106, "don't STOP<|endoftext|>J̌")]
    for block_tokens in (1 << 22, 700):
        found = pack(frame(rows), MODEL, length=256, block_tokens=block_tokens).collect()
        sequences = check(rows, found, 256)
    used = sum(len(r["ids"]) for r in found)
    assert used / (256 * len(sequences)) > 0.7


def test_little_padding(frame, prose):
    found = pack(frame([(key, prose(300) + ".") for key in range(60)], partitions=1), MODEL, digest=True).collect()
    filled = {}
    for r in found:
        filled[r["sequence_id"]] = filled.get(r["sequence_id"], 0) + r["length"]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in list(filled.values())[:-1])
    assert padding < 0.02 * sum(filled.values())


def test_empty_table_and_extra_columns(frame):
    assert pack(frame([]), MODEL).collect() == []
    found = pack(frame([(1, "a", 9, 8)], "doc_id int, text string, start int, ids int"), MODEL).collect()
    assert [(r["doc_id"], r["start"], r["length"]) for r in found] == [(1, 0, 2)]


def test_cuts_are_the_cheapest():
    dice = random.Random(2)
    for _ in range(60):
        places = np.cumsum([0, *(dice.randrange(1, 7) for _ in range(9))])
        penalties = np.array([0, *(dice.choice([0, 1, 4]) for _ in range(8)), 0])
        length = 8

        def cost(inner):
            edges, total = [0, *inner, len(places) - 1], sum(int(penalties[k]) for k in inner)
            for a, b in itertools.pairwise(edges):
                size = int(places[b] - places[a])
                if size > length:
                    return None
                total += 0 if size & (size - 1) == 0 else length - size
            return total

        options = [cost(inner) for k in range(9) for inner in itertools.combinations(range(1, len(places) - 1), k)]
        chosen = choose_cuts(places, penalties, length)
        assert cost([int(np.searchsorted(places, c)) for c in chosen[:-1]]) == min(x for x in options if x is not None)
        assert chosen[-1] == places[-1]


def test_ragged():
    assert ragged(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert ragged(np.array([1]), np.array([0])).tolist() == []
