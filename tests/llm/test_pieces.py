import itertools
import random

import numpy as np
import public_tokenizers
import pytest

from holdfast.llm.pieces import Pieces, decode, encode, prefix_products, times

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return Pieces(MODEL)


def total(pieces, text, cuts):
    edges = [0, *cuts, len(text)]
    parts = [text[a:b] for a, b in itertools.pairwise(edges)]
    scores = [pieces.scores.get(p, pieces.unknown if len(p) == 1 else float("-inf")) for p in parts]
    return sum(scores)


def test_segmentation_has_the_greatest_score(pieces):
    dice = random.Random(4)
    for _ in range(40):
        text = "▁" + "".join(dice.choices(["a", "t", "h", "e", "in", "é", "文"], k=dice.randrange(1, 9)))
        best = max(total(pieces, text, cuts) for n in range(len(text)) for cuts in itertools.combinations(range(1, len(text)), n))
        assert pieces.segmented(text)[1] == best


def test_no_library_segmentation_scores_more(pieces, prose):
    for _ in range(20):
        text = prose(12)
        own, other = pieces.ids_of(pieces.model.normalize(text)).tolist(), pieces.model.encode(text)
        assert sum(map(pieces.model.get_score, own)) >= sum(map(pieces.model.get_score, other))
        assert pieces.model.decode(own) == text


def test_scan_equals_one_pass_and_round_trip(frame, prose):
    dice = random.Random(1)
    rows = [(key, prose(dice.randrange(1, 200))) for key in range(12)]
    rows += [(20, None), (21, ""), (22, "\n\n\t "), (None, "no id"), (None, None), (23, "twice"), (23, "twice"), (24, "🙂" * 90), (25, prose(20_000))]
    rows += [(30 + k, "".join(dice.choices(["thethe", "in", "er", "abc", "文字", "é", "  "], k=300))) for k in range(4)]
    df = frame(rows)
    key = lambda r: (str(r["doc_id"]), str(r["ids"]))
    plain = sorted(encode(df, MODEL).collect(), key=key)
    assert len(plain) == len(rows)
    assert sorted(encode(df, MODEL, chunk=50).collect(), key=key) == plain
    texts = sorted((str(r["doc_id"]), str(r["text"])) for r in decode(encode(df, MODEL, chunk=700), MODEL).collect())
    assert texts == sorted((str(a), str(b)) for a, b in rows)


def test_empty_tables_and_columns(frame):
    assert encode(frame([]), MODEL).collect() == []
    found = encode(frame([(1, "a b", 2, 3)], "doc_id bigint, text string, chunk int, row int"), MODEL, chunk=2)
    assert found.columns == ["doc_id", "ids"] and found.count() == 1
    back = decode(frame([(1, [262, 263], "old", 4)], "doc_id bigint, ids array<int>, text string, row int"), MODEL)
    assert back.columns == ["doc_id", "ids", "row", "text"] and back.first()["text"] == "iner"


def test_products_are_associative():
    dice = np.random.default_rng(1)
    stack = dice.integers(-50, 0, (11, 4, 4)).astype(float)
    stack[dice.random(stack.shape) < 0.3] = -np.inf
    products = prefix_products(stack)
    so_far = stack[0]
    for k in range(1, 11):
        so_far = times(so_far, stack[k])
        assert np.array_equal(products[k], so_far)
