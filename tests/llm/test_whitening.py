import numpy as np
import pytest

from holdfast.llm.whitening import by_component, components_of, exact_deviations, whiten

VECTORS = "vec_id bigint, embedding array<double>"


def brute_force(vectors, most=32, weights=None):
    """x, weight sum, deviations, eigenvalues and whitened rows by NumPy on the whole table."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    w = np.ones(len(x), np.int64) if weights is None else weights
    n, sums = int(w.sum()), [int(s) for s in w @ x]
    deviations = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = (x * n - np.array(sums)) / n
    values, axes = np.linalg.eigh((centred * w[:, None]).T @ centred / n)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    return n, deviations, values, centred @ axes / np.sqrt(values), values / ((centred**2 * w[:, None]).sum() / n)


def some_vectors(count, d, seed=1):
    dice = np.random.default_rng(seed)
    return (dice.normal(size=(count, d)) * np.linspace(0.2, 2, d)).tolist()


def check(found, ids, vectors, most=32, weights=None):
    n, deviations, _, whitened, explained = brute_force(vectors, most, weights)
    found = {row["id"]: row for row in found.collect()}
    assert sorted(found) == sorted(ids)
    got = np.array([found[key]["whitened"] for key in ids])
    signs = np.sign((got * whitened).sum(axis=0))
    np.testing.assert_allclose(got * signs, whitened, atol=1e-8)
    for key, deviation in zip(ids, deviations):
        assert (found[key]["n"], int(found[key]["deviation"])) == (n, deviation)
        np.testing.assert_allclose(found[key]["explained"], explained, rtol=1e-9)
        assert found[key]["identity_error"] < 1e-9


def test_against_numpy_with_a_third_of_all_rows_equal(frame):
    vectors = some_vectors(400, 40) + [[0.25] * 40] * 200
    check(whiten(frame(list(enumerate(vectors)), VECTORS)), list(range(600)), vectors)


def test_weights_of_one_count_each_distinct_vector_once(frame):
    vectors = some_vectors(100, 6) + [[0.5] * 6] * 50
    w = np.array([1] * 101 + [0] * 49)
    check(whiten(frame(list(enumerate(vectors)), VECTORS), weights="one", components=4), list(range(150)), vectors, 4, w)
    with pytest.raises(ValueError):
        whiten(frame([], VECTORS), weights="half")


def test_rows_that_take_no_part_and_clashing_names(frame):
    vectors = some_vectors(50, 5)
    rows = [(n, v, 1, "a", 2.0) for n, v in enumerate(vectors)]
    bad = [None, [], [None] * 5, [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1e300] * 5, [1.0] * 4]
    rows += [(100 + n, v, 1, "b", 0.5) for n, v in enumerate(bad)]
    odd = f"{VECTORS}, copies int, x string, salt double"
    check(whiten(frame(rows, odd)), list(range(50)), vectors)


def test_repeated_ids_null_ids_and_floats(frame):
    vectors = [[float(np.float32(x)) for x in v] for v in some_vectors(30, 3)]
    rows = [(None if n < 2 else n // 2, v) for n, v in enumerate(vectors)]
    found = by_component(whiten(frame(rows, "vec_id bigint, embedding array<float>")))
    n, deviations, *_ = brute_force(vectors)
    expected = [(row[0], c, n, d) for row, d in zip(rows, deviations) for c in (1, 2, 3)]
    got = [tuple(row) for row in found.select("vec_id", "component", "n", "deviation").collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_directions_without_variance_are_left_out(frame):
    vectors = [[v[0], v[1], 3.0, v[0]] for v in some_vectors(40, 2)]
    found = whiten(frame(list(enumerate(vectors)), VECTORS)).collect()
    assert {len(row["whitened"]) for row in found} == {2}
    assert max(row["identity_error"] for row in found) < 1e-9
    same = whiten(frame([(n, [1.0, 2.0]) for n in range(9)], VECTORS))
    assert [(row["n"], int(row["deviation"]), row["whitened"]) for row in same.collect()] == [(9, 0, [])] * 9
    assert by_component(same).collect() == []


def test_empty_tables(frame):
    for rows in ([], [(1, None)]):
        found = by_component(whiten(frame(rows, VECTORS)))
        assert found.collect() == []
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_are_exact_beyond_64_bits(frame):
    x = np.array([[1_000_000, 999_990], [1_000_063, 1], [2**50, -(2**50)]], np.int64)
    for n in (3, 2**33 + 1):
        sums = [int(a) * (n // 3) + n // 7 for a in x.sum(axis=0)]
        assert exact_deviations(x, n, sums) == [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    rows = [(1, [2.0**44, 0.0]), (2, [0.0, 2.0**44]), (3, [0.0, 0.0])]
    n, deviations, *_ = brute_force([row[1] for row in rows])
    found = whiten(frame(rows, VECTORS)).orderBy("id").collect()
    assert [int(row["deviation"]) for row in found] == deviations


def test_a_large_common_offset_costs_no_digits(frame):
    vectors = some_vectors(200, 4)
    far = whiten(frame(list(enumerate(vectors)), VECTORS), offset=1 << 45).orderBy("id").collect()
    near = whiten(frame(list(enumerate(vectors)), VECTORS), offset=0).orderBy("id").collect()
    np.testing.assert_allclose([row["whitened"] for row in far], [row["whitened"] for row in near], atol=1e-12)


def test_components_of_a_matrix():
    values, axes, shares = components_of(np.diag([1.0, 4.0, 0.0]), 5)
    assert values.tolist() == [4, 1] and shares.tolist() == [0.8, 0.2]
    assert np.abs(axes).tolist() == [[0, 1], [1, 0], [0, 0]]
