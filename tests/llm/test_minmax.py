import random

import numpy as np
import pytest

from holdfast.llm import components, minmax
from holdfast.llm.arrays import mix
from holdfast.llm.minmax import bucket_names, near_copies, signatures, similarity
from tests.llm.test_near_duplicates import brute_force, collected, edited, order, written


def expected(rows, percent=85):
    found = [(*row, row[0] == row[2]) for row in brute_force(rows, percent=percent)]
    return sorted(found, key=order)


def some_documents(prose):
    dice = random.Random(11)
    rows = []
    for _ in range(25):
        base = prose(dice.randrange(6, 300))
        for share in (0, 0, 0.004, 0.01, 0.02, 0.03, 0.05):
            rows.append(edited(base, share, dice))
    rows += ["one two", "ONE  two", "one two three", "", None, " \t\n", prose(4000)]
    dice.shuffle(rows)
    return list(enumerate(rows))


def test_against_all_pairs(frame, prose):
    rows = some_documents(prose)
    assert collected(near_copies(frame(rows))) == expected(rows)
    assert len({row[2] for row in expected(rows)}) < len(rows) - 60


def test_a_large_group_of_near_copies_in_small_blocks(frame, prose):
    dice = random.Random(2)
    base = prose(200)
    rows = [(n, edited(base, 0.014, dice)) for n in range(150)] + [(150 + n, base) for n in range(80)]
    assert collected(near_copies(frame(rows), block=1 << 11)) == expected(rows)


def test_a_large_group_of_near_copies_takes_few_tables(frame, prose, monkeypatch):
    """Links are written once, and those of components found before are not walked again."""
    names = written(monkeypatch, components, minmax)
    dice = random.Random(2)
    base = prose(200)
    rows = [(n, edited(base, 0.014, dice)) for n in range(150)]
    assert collected(near_copies(frame(rows))) == expected(rows)
    assert len({row[2] for row in expected(rows)}) < 60
    assert len(names) < 30


def test_copies_that_do_not_link_with_their_hub_are_compared(frame, prose):
    """Chains: each links with the next only, and none with a third."""
    dice = random.Random(4)
    rows = []
    for _ in range(12):
        text = prose(300)
        for _ in range(6):
            rows.append(text)
            text = edited(text, 0.012, dice)
    rows = list(enumerate(rows))
    assert collected(near_copies(frame(rows), block=1 << 10)) == expected(rows)


def test_odd_rows_and_clashing_names(frame, prose):
    text = prose(50)
    rows = [(5, text), (5, text), (3, text), (None, text), (None, "alone " * 9), (9, None), (None, ""), (8, "hi")]
    assert collected(near_copies(frame(rows))) == expected(rows)
    odd = [(*row, 1, "x", 2) for row in rows]
    assert collected(near_copies(frame(odd, "doc_id bigint, text string, key int, buckets string, n int"))) == expected(rows)
    assert near_copies(frame([])).collect() == []


def test_a_signature_estimates_without_bias_and_min_max_varies_less():
    dice = np.random.default_rng(1)
    errors = []
    for _ in range(150):
        both = mix(dice.integers(1, 1 << 62, 600).astype(np.uint64))
        a, b = both[:480], both[120:]
        signed = signatures([np.unique(a), np.unique(b)], 60)
        errors.append(similarity(signed[0], signed[1]) - 0.6)
    assert abs(np.mean(errors)) < 0.015
    # 120 independent values would have this deviation; minimum and maximum of one permutation exclude each other a little.
    assert np.std(errors) < 1.15 * (0.6 * 0.4 / 120) ** 0.5


def test_equal_sets_share_all_buckets_and_bands_are_told_apart():
    one = np.unique(mix(np.arange(1, 40, dtype=np.uint64)))
    names = bucket_names(signatures([one, one[:1], one], 12), 4)
    assert (names[0] == names[2]).all()
    assert len(set(names.ravel().tolist())) == 8


def test_an_odd_number_of_values_is_refused(frame):
    with pytest.raises(ValueError):
        near_copies(frame([]), bands=3, rows=5)
