import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from holdfast.llm import components
from holdfast.llm.arrays import stored
from holdfast.llm.components import connected_components
from holdfast.llm.near_duplicates import EXTRA, KEY, _combined, _could_link, _could_share, _hubs, _needed_sets, _pack, _posted, _unpack, choose_extra, least_overlap, near_duplicates, one_of_each, overlaps

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_force(rows, words=5, percent=75):
    """All pairs by an inverted index of whole shingles, and union-find."""
    sets = []
    for _, text in rows:
        found = WORD.findall((text or "").encode().lower())
        if len(found) >= words:
            sets.append(frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1)))
        else:
            sets.append(frozenset([tuple(found)]) if found else frozenset())
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    index = defaultdict(list)
    for i, own in enumerate(sets):
        shared = defaultdict(int)
        for shingle in own:
            for j in index[shingle]:
                shared[j] += 1
            index[shingle].append(i)
        for j, count in shared.items():
            if 100 * count >= percent * (len(own) + len(sets[j]) - count):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, len(sets[i]), least.get(find(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)]


def order(row):
    return tuple(-1 if value is None else value for value in row)


def collected(df):
    return sorted(map(tuple, df.collect()), key=order)


def edited(text, share, dice):
    words = text.split()
    for place in range(len(words)):
        if dice.random() < share:
            words[place] = f"w{dice.randrange(10**6)}"
    return " ".join(words)


def test_equals_brute_force(frame, prose):
    dice = random.Random(3)
    rows, base = [], prose(160)
    passage = prose(60)
    for key in range(60):  # a group of near copies, some just linked and some just not
        rows.append((key, edited(base, dice.choice([0, 0.01, 0.02, 0.04, 0.08]), dice)))
    for key in range(60, 120):  # a passage that all of them share
        rows.append((key, f"{prose(dice.randrange(5, 120))} {passage} {prose(dice.randrange(5, 120))}"))
    for key in range(120, 160):
        rows.append((key, " ".join(base.split()[: dice.randrange(1, 160)])))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "two words"), (204, "TWO\twords"), (205, "two"), (None, base), (None, "a null id"), (206, "a null id"), (None, None)]
    rows += [(207, "repeat " * 400), (207, "repeat " * 400), (208, prose(30_000))]
    rows.append((209, rows[-1][1].upper()))
    got = collected(near_duplicates(frame(rows, partitions=5), block=8, sketch=1 << 14, bitmap=1 << 10))
    assert got == sorted(brute_force(rows), key=order)
    assert len({row[2] for row in got}) > 20


def test_two_copies_whose_hub_is_like_neither(frame, prose):
    base, common = prose(100).split(), prose(60)
    first, second = (base[:place] + ["changed"] + base[place + 1 :] for place in (30, 70))
    # The long document comes first and holds all that the copies share; its other words are common, so its prefix is of theirs.
    rows = [(1, f"{' '.join(base)} {common}"), (2, " ".join(first)), (3, " ".join(second))] + [(key, f"{prose(80)} {common} {prose(80)}") for key in range(10, 20)]
    got = collected(near_duplicates(frame(rows)))
    assert got == sorted(brute_force(rows), key=order)
    assert [row[2] for row in got[:3]] == [1, 2, 2]


def test_empty_and_extra_columns(spark, frame):
    assert near_duplicates(frame([]), sketch=1 << 14).collect() == []
    rows = [(1, "one two three four five six", 1, "x"), (2, "One two THREE four five six", 2, None)]
    df = frame(rows, "doc_id bigint, text string, n int, `key` string").withColumnsRenamed({"text": "body", "doc_id": "number"})
    assert collected(near_duplicates(df, "number", "body", sketch=1 << 14)) == [(1, 2, 1), (2, 2, 1)]


def test_one_of_each_keeps_columns(frame):
    text = "one two three four five six seven eight"
    rows = [(3, text, 1), (2, text.upper(), 2), (2, text.upper(), 2), (None, text, 3), (5, "other words stand here and stay", 4), (6, None, 5), (7, "", 6), (2, "same id yet another text here", 7)]
    kept = one_of_each(frame(rows, "doc_id bigint, text string, root int"))
    assert kept.columns == ["doc_id", "text", "root"]
    assert sorted(row["root"] for row in kept.collect()) == [2, 4, 5, 6, 7]


def test_more_extra_places_where_candidates_are_many():
    assert choose_extra(100, least_overlap(100, 75), np.ones(100)) == 1
    assert choose_extra(100, least_overlap(100, 75), np.full(100, 5000.0)) > 1
    assert least_overlap(4, 75) == 3


def test_overlaps():
    a, b = [np.array([1, 2, 3]), np.array([9])], [np.array([2, 3, 4]), np.array([9, 1]), np.array([], np.int64)]
    sizes = [np.array([len(x) for x in side]) for side in (a, b)]
    assert overlaps(np.concatenate(a), sizes[0], np.concatenate(b), sizes[1]).tolist() == [[2, 1, 0], [0, 1, 0]]


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    roots = dict(map(tuple, found.collect()))
    assert len(roots) == found.count() == 44
    assert {roots[i] for i in range(41)} == {0} and roots[300] == 100
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def written(monkeypatch, *modules):
    """Names of the tables that these modules write from now on."""
    names = []

    def noted(df, name, root=None):
        names.append(name)
        return stored(df, name, root)

    for module in modules:
        monkeypatch.setattr(module, "stored", noted)
    return names


def test_components_end_as_soon_as_all_hang_on_roots(spark, monkeypatch):
    """Every table written costs a file for each partition, however few links are left."""
    names = written(monkeypatch, components)
    stars = [(10 * hub, 10 * hub + i) for hub in range(5) for i in range(1, 8)]
    found = connected_components(spark.createDataFrame(stars, "a bigint, b bigint"))
    assert sorted(map(tuple, found.collect())) == sorted((10 * hub + i, 10 * hub) for hub in range(5) for i in range(8))
    assert names == ["edges-0", "seen-0"]
    names.clear()
    found = connected_components(spark.createDataFrame([*stars, (0, 10), (10, 20), (3, 40)], "a bigint, b bigint"))
    roots = dict(map(tuple, found.collect()))
    assert roots == {10 * hub + i: 30 if hub == 3 else 0 for hub in range(5) for i in range(8)}
    assert len(names) <= 8


def test_components_of_random_links(spark):
    dice = random.Random(5)
    for nodes, count in ((60, 30), (60, 60), (40, 120)):
        links = [(dice.randrange(nodes), dice.randrange(nodes)) for _ in range(count)]
        least = list(range(nodes))
        for _ in range(nodes):
            for a, b in links:
                least[a] = least[b] = min(least[a], least[b])
        found = connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
        assert sorted(map(tuple, found.collect())) == sorted((x, least[x]) for x in {x for a, b in links if a != b for x in (a, b)})


def test_one_shingle_in_every_documents_prefix(frame, prose):
    """Short documents that all begin alike: one posting list holds them all."""
    dice = random.Random(9)
    rows = [(n, "all of these begin alike " + prose(dice.randrange(0, 4))) for n in range(400)]
    rows += [(400 + n, rows[n][1] + (" x" if n % 2 else "")) for n in range(100)]
    assert collected(near_duplicates(frame(rows))) == sorted(brute_force(rows), key=order)


def test_one_of_each_takes_any_column_names(frame, prose):
    text = prose(60)
    rows = [(3, text, 1, "a", 2.0, None), (1, text, 2, "b", 1.0, 5), (2, "", 3, "c", 0.0, 6), (4, prose(60), 4, None, 0.0, 7)]
    docs = frame(rows, "doc_id bigint, text string, _id int, _key string, _own double, first_id int")
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.select("doc_id", "_id").collect()) == [(1, 2), (2, 3), (4, 4)]


class Sketch:
    value = np.ones(1 << 14, np.uint32)


def test_postings_are_narrow_and_keep_size_and_extra():
    """Postings are most of what is shuffled: a shingle, two longs and an int."""
    texts = [" ".join(f"w{k}" for k in range(n)) for n in (5, 40, 4000)]
    batch = pa.RecordBatch.from_arrays([pa.array([3, None, 1], pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    posted = pa.Table.from_batches(_posted(5, 75, Sketch)([batch]))
    assert [(f.name, str(f.type)) for f in posted.schema] == [("token", "int64"), ("doc_id", "int64"), ("fp", "int64"), ("size", "int32")]
    found = {(row["doc_id"], row["size"] >> 3, EXTRA[row["size"] & 7]) for row in posted.to_pylist()}
    assert {(doc, n) for doc, n, _ in found} == {(3, 1), (None, 36), (1, 3996)} and len(found) == 3

    both = pa.RecordBatch.from_arrays(
        [pa.array([7, 7, 7]), pa.array([1, 2, None], pa.int64()), pa.array([10, 20, 30]), pa.array([100 << 3 | 5, 90 << 3, 80 << 3 | 2], pa.int32())],
        names=["token", "doc_id", "fp", "size"],
    )
    rows = pa.Table.from_batches(_hubs([both])).to_pylist()
    assert {(r["key"]["fp"], r["key"]["n"], r["extra"], r["hub"]["fp"], r["hub"]["n"]) for r in rows} == {
        (20, 90, EXTRA[0], 10, 100), (30, 80, EXTRA[2], 10, 100), (10, 100, EXTRA[5], 10, 100)
    }


def test_needed_sets_come_once_with_their_mark(spark, tmp_path):
    """So that only the sets of hubs are sent to the join that wants hubs."""
    docs = spark.createDataFrame([("a b c d e f",), ("a b c d e f",), ("g h i j k",), ("l m n o p",)], "text string").repartition(3)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["a b c d e f", "g h i j k", "l m n o p"])], names=["doc_id", "text"])
    posted = pa.Table.from_batches(_posted(5, 75, Sketch)([batch])).to_pylist()
    keys = {row["doc_id"]: (row["fp"], row["size"] >> 3) for row in posted}
    needed = spark.createDataFrame([(keys[1], True), (keys[2], False)], "key struct<fp: bigint, n: int>, is_hub boolean")
    found = _needed_sets(docs, needed, 5, 1 << 10, str(tmp_path)).collect()
    assert sorted((tuple(r.key), len(r.sh), r.is_hub) for r in found) == sorted([(keys[1], 2, True), (keys[2], 1, False)])


def postings(lists):
    """Postings of lists of (doc_id, size); every set is its own, named by its doc_id."""
    rows = [(token, doc, n) for token, docs in lists for doc, n in docs]
    columns = [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] << 3 for r in rows], pa.int32())]
    return pa.RecordBatch.from_arrays(columns, names=["token", "doc_id", "fp", "size"])


def test_lists_are_cut_where_sizes_cannot_link():
    """Chance meetings of short and long documents grow with the square of the table, and give no rows."""
    whole = postings([(1, [(1, 100), (2, 1000)]), (2, [(1, 100), (2, 1000), (3, 134), (4, 750), (5, 10)]), (3, [(1, 100), (3, 133), (6, 178)]), (4, [(9, 1), (10, 1000)])])
    found = {(r["token"], r["key"]["fp"], r["hub"]["fp"]) for batch in _hubs([whole], 75) for r in batch.to_pylist()}
    # 100 and 134 are too far apart, 100 and 133 are not; the last list may go on, so it stays whole.
    assert {x for x in found if x[0] < 3} == {(2, 2, 2), (2, 4, 2)}
    assert {x for x in found if x[0] == 3} == {(3, 1, 1), (3, 3, 1)}
    assert {x for x in found if x[0] == 4} == {(4, 9, 9), (4, 10, 9)}


def test_lists_over_several_batches_lose_no_pair():
    dice = random.Random(5)
    sizes = {doc: dice.choice([40, 50, 60, 80, 90, 300, 1000]) for doc in range(200)}
    lists = [(token, [(doc, sizes[doc]) for doc in sorted(dice.sample(range(200), dice.choice([1, 2, 3, 9, 30])))]) for token in range(80)]
    whole = postings(lists)
    for step in (1, 2, 7, 1000):
        hub = {}
        for batch in _hubs([whole.slice(k, step) for k in range(0, whole.num_rows, step)], 75):
            for r in batch.to_pylist():
                assert hub.setdefault((r["token"], r["key"]["fp"]), r["hub"]["fp"]) == r["hub"]["fp"] and r["key"]["n"] == sizes[r["key"]["fp"]]
        assert all((token, x) in hub for (token, _), x in hub.items())
        for token, docs in lists:
            for a, n in docs:
                for b, m in docs:
                    if a != b and min(n, m) * 100 >= max(n, m) * 75:
                        assert hub[token, a] == hub[token, b]


def test_sets_of_all_sizes_that_share_passages(spark, frame, prose):
    dice = random.Random(11)
    passages = [prose(12) for _ in range(4)]
    rows = [(key, f"{prose(dice.choice([2, 5, 9, 20, 60]))} {dice.choice(passages)} {prose(dice.choice([0, 3, 30]))}") for key in range(150)]
    rows += [(200 + key, edited(dice.choice(rows)[1], 0.02, dice)) for key in range(80)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        assert collected(near_duplicates(frame(rows, partitions=3), block=8, sketch=1 << 14, bitmap=1 << 10)) == sorted(brute_force(rows), key=order)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_what_cannot_share_enough_cannot_link(spark):
    dice, rows = random.Random(2), []
    for _ in range(4000):
        n, m = dice.randrange(1, 60), dice.randrange(1, 60)
        k, j = (dice.choice([x for x in EXTRA if x <= least_overlap(size, 75)]) for size in (n, m))
        prefix, hub_prefix = n - least_overlap(n, 75) + k, m - least_overlap(m, 75) + j
        most = dice.randrange(1, prefix + 1)
        rows.append(((0, n), (1, m), k, j, prefix, hub_prefix, most, dice.randrange(0, min(most, hub_prefix) + 1)))
    df = spark.createDataFrame(rows, f"key {KEY}, hub {KEY}, key_extra int, hub_extra int, key_prefix int, hub_prefix int, most int, shared int").withColumn("prefix", F.col("key_prefix"))
    found = df.select(_could_link(75, F.col("shared"), "key", "hub"), _could_share(75, F.col("most"), "key", "hub")).collect()
    assert not any(link and not share for link, share in found)
    assert any(link for link, _ in found) and sum(not share for _, share in found) > 1000


def test_a_task_sums_its_rows_of_the_sketch():
    """So that what is shuffled does not grow with the tasks that counted."""
    counts = [np.arange(1 << 14, dtype=np.uint32), np.full(1 << 14, 7, np.uint32)]
    batch = lambda parts, found: pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([_pack(x) for x in found], pa.binary())], names=["part", "counts"])
    rows = pa.Table.from_batches(_combined([batch([3, 5], counts), batch([3], counts[1:])])).to_pylist()
    found = {row["part"]: _unpack(row["counts"]) for row in rows}
    assert len(rows) == 2 and (found[3] == counts[0] + 7).all() and (found[5] == 7).all()
    assert list(_combined([])) == []


def test_needed_sets_take_their_hubs_along(spark, tmp_path):
    """So that the sets are not joined with the stars again."""
    docs = spark.createDataFrame([("a b c d e f",), ("g h i j k",)], "text string")
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a b c d e f", "g h i j k"])], names=["doc_id", "text"])
    keys = {row["doc_id"]: (row["fp"], row["size"] >> 3) for row in pa.Table.from_batches(_posted(5, 75, Sketch)([batch])).to_pylist()}
    needed = spark.createDataFrame([(keys[1], True, []), (keys[2], False, [keys[1]])], f"key {KEY}, is_hub boolean, hubs array<{KEY}>")
    found = _needed_sets(docs, needed, 5, 1 << 10, str(tmp_path)).collect()
    assert sorted((tuple(r.key), r.is_hub, [tuple(x) for x in r.hubs]) for r in found) == sorted([(keys[1], True, []), (keys[2], False, [keys[1]])])
