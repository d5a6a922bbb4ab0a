import numpy as np

from holdfast.llm.line_dedup import build_hash, dedup_lines, slots

LONG = "This line is long enough to count, and many documents hold it."


def collected(df):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect()), key=repr)


def rows():
    out = [(key, f"own line {key}\n  {LONG}\t\nend {key}") for key in range(1, 7)]
    out += [(7, LONG.upper() + "\n" + LONG), (8, None), (9, ""), (10, "\n\n"), (None, LONG + "\nkept"), (None, "x\n" + LONG), (11, "short\nshort")]
    out += [(key, "short line, but everywhere") for key in range(20, 30)]
    out += [(40, "A line that only one document has, however often it is repeated.") for _ in range(6)]
    out += [(50, "x" * 200_000 + "\n" + "y" * 39), (51, "é" * 40 + "\nÉ"), (52, "é" * 40), (53, "é" * 40), (54, " " + "é" * 40), (55, "é" * 40 + "\r")]
    return out


def test_largest_id_keeps_shared_lines(frame):
    got = {(r["doc_id"], r["n_lines"]): r for r in dedup_lines(frame(rows())).collect() if r["doc_id"] is not None}
    assert got[1, 3]["text"] == "own line 1\nend 1" and got[1, 3]["n_dropped"] == 1
    assert got[7, 2]["text"] == LONG.upper() + "\n" + LONG
    assert got[8, 1]["text"] == got[9, 1]["text"] == "" and got[10, 3]["text"] == "\n\n"
    assert got[40, 1]["n_dropped"] == 0 and got[51, 2]["text"] == "É" and got[55, 1]["n_dropped"] == 0
    assert sum(r["n_dropped"] for r in got.values()) == 6 + 4


def test_sharded_way_gives_the_same(frame):
    df = frame(rows())
    broadcast, routed = collected(dedup_lines(df)), collected(dedup_lines(df, broadcast_bytes=0, shard_keys=1))
    assert broadcast == routed
    assert [row for row in broadcast if row[0] is None] == [(None, "kept", 2, 1), (None, "x", 2, 1)]


def test_empty_table_and_columns(frame):
    schema = "n_lines string, text string, doc_id int, h1 bigint, id string"
    assert dedup_lines(frame([], schema)).collect() == []
    found = dedup_lines(frame([("old", "a\nb", 1, 5, "z")], schema))
    assert found.columns == ["text", "doc_id", "h1", "id", "n_lines", "n_dropped"]
    assert tuple(found.first()) == ("a\nb", 1, 5, "z", 2, 0)


def test_hash_is_minimal_and_perfect():
    dice = np.random.default_rng(1)
    for count in (0, 1, 2, 1000, 30_000):
        h1, h2 = dice.integers(-(2**62), 2**62, (2, count))
        h1[: count // 2] = 5  # half of the keys differ in one word only
        h2[: count // 2] = np.arange(count // 2)
        built = build_hash(h1, h2)
        assert sorted(slots(h1, h2, *built).tolist()) == list(range(count))
        assert 64 * len(built[0]) <= 6 * count + 64 * len(built[2])
