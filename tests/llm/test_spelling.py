import random
import re
import zlib
from collections import Counter

import pytest

from holdfast.llm.spelling import RUN, count_words, neighbours, rotations, text_slices, variant_groups

LOWER = str.maketrans({chr(code): chr(code + 32) for code in range(65, 91)})


def one_edit(a, b):
    """Whether the words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(counts, ratio=2):
    """Every word compared with every other."""
    found = {}
    for word, n in counts.items():
        near = [other for other in counts if one_edit(word, other)]
        best = min(near, key=lambda other: (-counts[other], other), default=None)
        found[word] = (best if best and counts[best] >= ratio * n else None, n, len(near))
    rows = []
    for word, (form, n, near) in found.items():
        root = word
        while found[root][0]:
            root = found[root][0]
        rows.append((word, form, root, n, near, counts.get(form)))
    return sorted(rows)


def counted(rows, damage=None):
    """Words of (doc_id, text) by one pass over whole texts."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(RUN, text or ""):
            run = run.translate(LOWER)
            check = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and check % damage == 0:
                run = run[: check % len(run)] + run[check % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 3 and len(word) >= 5}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda row: row[0])


def test_variants_against_all_pairs(spark):
    dice = random.Random(3)
    counts = {"".join(dice.choices("abé", k=dice.randrange(5, 8))): dice.randrange(3, 400) for _ in range(600)}
    found = variant_groups(spark.createDataFrame(list(counts.items()), "word string, n bigint"))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows_of(found) == brute_force(counts)
    assert sum(row[1] is not None for row in brute_force(counts)) > 50


def test_runs_of_equal_letters_count_once_and_ties_go_by_code_point(spark):
    counts = {"aaaaa": 3, "aaaaaa": 9, "aabaaa": 9, "aaaaé": 9, "aaaaz": 9, "zzzzz": 3}
    found = {row["word"]: row for row in variant_groups(spark.createDataFrame(list(counts.items()), "word string, n bigint")).collect()}
    assert (found["aaaaa"]["n_near"], found["aaaaa"]["form"], found["aaaaa"]["form_n"]) == (4, "aaaaaa", 9)
    assert (found["zzzzz"]["n_near"], found["zzzzz"]["form"], found["zzzzz"]["root"]) == (0, None, "zzzzz")


def test_roots_follow_forms_to_the_last(spark):
    chain = ["abcdefgh"]
    for place in range(8):
        chain.append(chain[-1][:place] + "z" + chain[-1][place + 1 :])
    counts = {word: 3 * 2**step for step, word in enumerate(chain)}
    found = variant_groups(spark.createDataFrame(list(counts.items()), "word string, n bigint"))
    assert {row["root"] for row in found.collect()} == {chain[-1]}


def test_a_ratio_that_could_go_round_is_refused(spark):
    with pytest.raises(ValueError):
        variant_groups(spark.createDataFrame([("abcde", 3)], "word string, n bigint"), ratio=1)


def test_a_group_is_no_larger_than_the_alphabet_and_one(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [(f"abc{x}de", 3) for x in letters] + [("abcde", 1000)] + [(f"abcde{x}{y}", 3) for x in letters for y in letters]
    found = rotations(spark.createDataFrame(words, "word string, n bigint")).groupBy("key").count()
    assert found.agg({"count": "max"}).first()[0] == len(letters) + 1


def test_counted_words_and_their_damage(frame):
    dice = random.Random(5)
    words = ["Straße", "NAÏVE", "colour", "neighbour", "über", "été", "centre", "x", "Theatre"]
    rows = [(n, " ".join(dice.choices(words, k=dice.randrange(0, 400))) + "-9_" * (n % 3)) for n in range(60)]
    rows += [(None, "colour centre " * 40), (7, rows[7][1]), (8, None), (9, "")]
    for damage in (None, 97, 3):
        found = count_words(frame(rows), damage=damage)
        assert dict(map(tuple, found.collect())) == counted(rows, damage)
    assert any(len(word) == 5 and word.startswith("colou"[:3]) for word in counted(rows, 3))


def test_the_whole_way_with_other_columns_and_empty_tables(frame, spark):
    rows = [(n, "colour color colour centre center " * 3, "a", "b", 1) for n in range(30)]
    odd = "doc_id bigint, text string, word string, key string, n int"
    found = variant_groups(count_words(frame(rows, odd), damage=97))
    assert rows_of(found) == brute_force(counted([row[:2] for row in rows], 97))
    for empty in ([], [(1, None)], [(None, "")]):
        assert variant_groups(count_words(frame(empty))).collect() == []
    assert neighbours(spark.createDataFrame([], "word string, n bigint")).collect() == []


def test_long_texts_are_cut_between_words():
    run = re.compile(RUN)
    text = "abc déf " * 50 + "x" * 100 + " 12 yz"
    for most in (1, 3, 7, 64, 10**6):
        parts = list(text_slices(text, run, most))
        assert "".join(parts) == text
        assert [w for part in parts for w in run.findall(part)] == run.findall(text)
    assert list(text_slices("", run)) == []
