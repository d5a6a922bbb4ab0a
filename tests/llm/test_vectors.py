import numpy as np
import pytest

from holdfast.llm import norm_topk, permutation_index
from holdfast.llm.norm_topk import coordinate_matches

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(count, size=16, seed=1, spread=False):
    dice = np.random.default_rng(seed)
    x = dice.normal(size=(count, size)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if spread:
        x *= dice.lognormal(0, 1.0, (count, 1)).astype(np.float32)
    return x


def odd_rows(size=16):
    """Rows that take no part, and repeated ones."""
    bad = [None, [], [1.0] * (size - 1), [float("nan")] * size, [float("inf")] + [0.0] * (size - 1), [None] + [1.0] * (size - 1)]
    return [(10_000 + 20 * k, v, 0) for k, v in enumerate(bad)] + [(None, [1.0] * size, 0)]


def nearest(ids, scores_of, queries, top):
    """Several queries of one id are answered as one."""
    found = {}
    for q in queries:
        scores = scores_of(q)
        order = [k for k in np.lexsort((ids, -scores)) if ids[k] != ids[q]][:top]
        found.setdefault(int(ids[q]), []).extend((-scores[k], int(ids[k])) for k in order)
    return sorted((q, rank + 1, key, -less) for q, own in found.items() for rank, (less, key) in enumerate(sorted(own)[:top]))


@pytest.mark.parametrize("spread", [False, True])
def test_exact_search_equals_brute_force(frame, spread):
    x = vectors(900, spread=spread)
    x[100:400] = x[100]  # a third are one vector
    x[401] = 0
    x[402] = -x[403]
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    df = frame(rows + odd_rows() + rows[:50], SCHEMA)
    ids = np.r_[np.arange(len(x)), np.arange(50)]
    whole = np.floor(256 * x.astype(np.float64)).astype(np.int64)[ids]
    expected = nearest(ids, lambda q: whole @ whole[q], np.flatnonzero(ids % 20 == 0), 5)
    got = norm_topk.search(df, df.where("vec_id % 20 = 0"), block=64, query_block=16, seeds=40)
    assert sorted(map(tuple, got.collect())) == expected


def test_index_recall_and_ranks(frame):
    x = vectors(3000)
    x[100:1100] = x[100]
    df = frame([(k, v.tolist(), 0) for k, v in enumerate(x)] + odd_rows(), SCHEMA)
    got = permutation_index.search(df, df.where("vec_id % 20 = 0"), block=1000, candidates=190).collect()
    wide = x.astype(np.float64)
    expected = nearest(np.arange(len(x)), lambda q: (wide * wide[q]).sum(axis=1), range(0, len(x), 20), 20)
    assert len(got) == len(expected)
    assert len({(r[0], r[2]) for r in got} & {(r[0], r[2]) for r in expected}) >= 0.9 * len(expected)
    by_query = {}
    for query, rank, key, score in sorted(map(tuple, got)):
        assert query != key and score == (wide[query] * wide[key]).sum()
        before = by_query.get(query, (0, np.inf, -1))
        assert rank == before[0] + 1 and (-score, key) > (-before[1], before[2])
        by_query[query] = rank, score, key


def test_index_follows_length(frame):
    x = vectors(600, seed=4, spread=True)
    df = frame([(k, v.tolist(), 0) for k, v in enumerate(x)], SCHEMA)
    got = permutation_index.search(df, df.where("vec_id % 20 = 0"), block=300, candidates=120).collect()
    expected = nearest(np.arange(len(x)), lambda q: x.astype(float) @ x[q].astype(float), range(0, len(x), 20), 20)
    assert len({(r[0], r[2]) for r in got} & {(r[0], r[2]) for r in expected}) >= 0.9 * len(expected)


def test_few_rows_and_other_names(frame):
    schema = "id bigint, v array<double>, score int, rank int"
    rows = [(0, [1.0, 0.0], 1, 1), (1, [1.0, 0.0], 2, 2), (2, [0.5, 0.5], 3, 3)]
    df = frame(rows, schema)
    for search, top in ((permutation_index.search, 20), (norm_topk.search, 5)):
        assert search(frame([], schema), frame([], schema), "id", "v").collect() == []
        assert search(df, frame([], schema), "id", "v").collect() == []
        got = [tuple(r)[:3] for r in search(df, df.where("id = 0"), "id", "v").orderBy("rank").collect()]
        assert got == [(0, 1, 1), (0, 2, 2)]
    zeros = frame([(k, [0.0, 0.0], 0, 0) for k in range(8)], schema)
    assert permutation_index.search(zeros, zeros, "id", "v").collect() == []
    assert [r["vec_id"] for r in norm_topk.search(zeros, zeros.where("id = 1"), "id", "v").orderBy("rank").collect()] == [0, 2, 3, 4, 5]


@pytest.mark.parametrize("search", [permutation_index.search, norm_topk.search])
def test_rows_of_one_id_and_vectors_of_several_lengths(frame, search):
    rows = [(0, [1.0, 0.0], 0), (1, [0.5, 0.0], 0), (1, [0.9, 0.0], 0), (1, [0.9, 0.0], 0), (2, [0.25, 0.0], 0)]
    # More rows of another length than of this one, and a query among them.
    rows += [(k, [1.0, 1.0, k / 64], 0) for k in range(20, 40)]
    df = frame(rows, SCHEMA)
    got = search(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()
    one = 256 * 256 if search is norm_topk.search else 1.0
    assert [(r["vec_id"], round(r["score"] / one, 2)) for r in got if r["query_id"] == 0] == [(1, 0.9), (1, 0.9), (1, 0.5), (2, 0.25)]
    assert [r["vec_id"] for r in got if r["query_id"] == 20][:3] == [39, 38, 37]


def test_default_parameters_reach_the_recall_on_full_blocks(frame):
    """Two full blocks of the default size."""
    x = vectors(8192, 64, seed=2)
    df = frame([(k, v.tolist(), 0) for k, v in enumerate(x)], SCHEMA)
    got = permutation_index.search(df, df.where("vec_id % 20 = 0")).collect()
    wide = x.astype(np.float64)
    expected = nearest(np.arange(len(x)), lambda q: wide @ wide[q], range(0, len(x), 20), 20)
    assert len({(r[0], r[2]) for r in got} & {(r[0], r[2]) for r in expected}) >= 0.9 * len(expected)


def test_coordinates_lose_no_match():
    x, q = vectors(4000, 8, seed=3).astype(float), vectors(1, 8, seed=9)[0].astype(float)
    q /= np.linalg.norm(q)
    for threshold in (0.3, 0.6, 0.9):
        kept = coordinate_matches(x / np.linalg.norm(x, axis=1, keepdims=True), q, threshold)
        assert kept[x @ q >= threshold * np.linalg.norm(x, axis=1)].all() and not kept.all()
